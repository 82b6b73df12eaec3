"""Pages whose article is known."""

from tierfold.llm.html_text import extract_text, main_text

BODY = " ".join(f"Sentence number {i}, which says something." for i in range(12))


def page(inner, before="", after="", wrap="article"):
    return (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p><p>no';</script></head>"
        f"<body class='has-sidebar'><header>Site name</header><nav><ul><li><a href='/'>Home</a></li></ul></nav>{before}"
        f"<{wrap}>{inner}</{wrap}>{after}<footer>&copy; us</footer></body></html>"
    )


def test_article_without_what_surrounds_it():
    around = (
        "<div class='ad'>Buy, buy, buy now. It is good.</div><div id='cookie-notice'>We use cookies.</div>"
        "<aside><p>Elsewhere, a long text that is not part of it. Really not.</p></aside>"
        "<form><p>Your name</p><input><button>Go</button></form><section class='comments'><p>First! Nice text.</p></section>"
    )
    inner = f"<h1>A title</h1><p>{BODY}<p>Short.</p><ul><li>one</li><li>two</li></ul>"
    expected = f"A title\n\n{BODY}\n\nShort.\n\none\n\ntwo"
    assert main_text(page(inner, around, around)) == expected
    assert main_text(page(inner + around)) == expected


def test_without_an_article_element():
    menu = "<div><ul>" + "".join(f"<li><a href='/{i}'>Page {i}</a></li>" for i in range(9)) + "</ul></div>"
    assert main_text(page(f"<h2>A title</h2><p>{BODY}</p><p>Short.</p>", menu, menu, "div")) == f"A title\n\n{BODY}\n\nShort."


def test_character_references_and_white_space():
    inner = f"<p>a &amp; b&nbsp;&#10; <b>c</b>d<br>e &lt;p&gt; &eacute;&quot</p><!-- no --><p>\n {BODY}\n</p><p> </p>"
    assert main_text(page(inner)) == f'a & b cd e <p> é"\n\n{BODY}'


def test_unclosed_and_cut_off():
    assert main_text(f"<article><p><b>One.<br><p>{BODY}</p><p>Two &am") == f"One.\n\n{BODY}\n\nTwo &am"
    assert main_text(f"<article><p>{BODY}</p><script>x") == BODY
    assert main_text(f"<article><p>{BODY}</p><!-- x") == BODY
    assert main_text(f"<article><p>{BODY}</p><p cla") == BODY
    assert main_text(f"<p>{BODY} 1 < 2</p></div></p></article>") == f"{BODY} 1 < 2"


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<html><nav>x</nav></html>") == ""
    assert main_text("just words") == "just words"
    assert main_text("<a href='" * 20_000) is not None
    assert main_text("<" * 50_000 + "<p " * 20_000) is not None
    assert main_text("<div>x" * 30_000).count("x") > 0
    assert main_text("<b>" * 30_000 + "</i>" * 30_000 + BODY) == BODY
    many = "<article>" + "<div>" * 3000 + f"<p>{BODY}</p>" * 300
    assert main_text(many).count(BODY) == 300


def test_layout_words_round_the_page_take_nothing():
    inner = f"<h1>A title</h1><p>{BODY}</p><p>Short.</p>"
    expected = f"A title\n\n{BODY}\n\nShort."
    around = "<div class='ad'>Buy, buy, buy now.</div>"
    for opened, closed in (("<div class='no-sidebar'>", "</div>"), ("<div class='content has-sidebar'>", "</div>"), ("<form id='aspnetForm'>", "</form>")):
        for wrap in ("article", "div"):
            assert main_text(page(inner, opened + around, around + closed, wrap)) == expected


def test_sections_whose_names_hold_a_layout_word_among_others_stay():
    more = " ".join(f"Another thing to be said, number {i}, is this." for i in range(9))
    names = ("related-work", "social-impact", "search-results-explained", "no-comments", "notice-period", "banner-history")
    for name in (*names, "section-two"):
        inner = f"<section class='intro'><h2>One</h2><p>{BODY}</p><p>{BODY}</p></section><section class='{name}'><h2>Two</h2><p>{more}</p></section>"
        for wrap in ("article", "div"):
            assert main_text(page(inner, wrap=wrap)) == f"One\n\n{BODY}\n\n{BODY}\n\nTwo\n\n{more}", (name, wrap)


def test_layout_names_and_mixed_names_beside_low_ratios_go():
    comment = "<p>First! Such a nice text, thank you. I have read it twice, and will do so again.</p>"
    for name in ("comments", "comments-list", "comment-117", "related-posts", "cookie_bar", "ad-slot-3", "sidebar-left"):
        assert main_text(page(f"<p>{BODY}</p><div class='{name}'>{comment * 3}</div>")) == BODY, name
    for name in ("promo-summer", "newsletter-acme", "share-it-now"):
        assert main_text(page(f"<p>{BODY}</p><div class='{name}'><p>Get it now</p><p>Only today</p></div>")) == BODY, name


def test_stand_ins_nest_and_end_with_what_is_around_them():
    for tag in ("svg", "math", "object", "noscript", "template", "canvas"):
        nested = f"<{tag}><g><{tag}>a</{tag}>b</g>c</{tag}>"
        assert main_text(page(f"<p>{BODY}</p>{nested}<p>{BODY}</p>")) == f"{BODY}\n\n{BODY}", tag
        assert main_text(page(f"<div><p>{BODY}</p><{tag}>no</div><p>{BODY}</p>")) == f"{BODY}\n\n{BODY}", tag
    assert main_text(page(f"<p>{BODY}</p><svg><path d='M0'><p>{BODY}</p>")) == f"{BODY}\n\n{BODY}"
    assert main_text(page(f"<p>{BODY}</p><svg><foreignObject><div>label</div></foreignObject></svg><p>{BODY}</p>")) == f"{BODY}\n\n{BODY}"


def test_the_head_of_an_article_keeps_its_title():
    assert main_text(page(f"<div class='entry-header'><h1>A title</h1></div><p>{BODY}</p>")) == f"A title\n\n{BODY}"


def test_teasers_in_articles_take_no_main_text():
    teasers = "".join(f"<article><h2>Teaser {i}</h2><p>Read on, here.</p></article>" for i in range(4))
    for before, after in ((teasers, ""), ("", teasers)):
        assert main_text(page(f"<h1>A title</h1><p>{BODY}</p>", before, after, "div")) == f"A title\n\n{BODY}"


def test_table(spark):
    rows = [(1, "u", page(f"<p>{BODY}</p>"), "x"), (None, None, None, "y"), (1, "u", page(f"<p>{BODY}</p>"), "x")]
    pages = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING, text STRING")
    found = extract_text(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in found.collect()) == [(0, "", 0)] + [(1, BODY, len(BODY))] * 2
    assert extract_text(pages.limit(0)).collect() == []
