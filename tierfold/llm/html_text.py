"""Main text of web pages by tag-path ratios.

Every text node has a tag path, from the root to its element. Per page and path, the length of text
outside links and the punctuation per node are aggregated and fused into one score; scores are
smoothed over the nodes in page order, and paths whose mean is not far below the best are content.
All nodes of a content path belong to the text, so short paragraphs stay beside long ones. Scripts,
styles, nav and footer are left out first. Elements that rarely are an article's text by their name
or by a word of their class, id or role (forms, adverts and the like) only score less, and not at
all less if most of the page's text is in them. A class, id or role that joins such a word with words
that are none of layout ("related-work") counts only beside a low ratio: not if its element's
ratio of text and punctuation is like that of the page's other text.

Pages are independent: each is parsed by itself inside a task.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tierfold.llm.common import name_of

#: Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe textarea title".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody tfoot thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CELLS = frozenset("td th br".split())
#: Opening one of these ends an open element of the same group.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}}
SIBLINGS |= {"th": {"td", "th"}, "option": {"option"}}
CONTAINERS = frozenset("ul ol dl table tbody thead tfoot select article section div body".split())
#: What stands in for other content; left out with all that is nested in it.
STAND_INS = frozenset("noscript template svg math object canvas".split())
#: Of these, the ones whose content is no HTML: a block that opens in them ends them.
FOREIGN = frozenset("svg math".split())
NOT_TEXT = frozenset("head nav footer".split()) | STAND_INS
RARELY_TEXT = frozenset("aside form button select dialog menu label fieldset".split())
ARTICLE = frozenset("article main".split())
#: Words of class, id or role that name what rarely is an article's text.
HINTS = frozenset(
    "ad ads advert advertisement advertising advertorial sponsor sponsored promo promotion banner sidebar nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login comment comments replies respond disqus "
    "share sharing social related recommended widget toolbar pagination pager copyright search contentinfo "
    "complementary dialog hidden".split()
)
#: Words that stand beside those in names of layout, such as cookie-bar or comments-list.
LAYOUT = frozenset(
    "area bar block body bottom box btn button buttons card cards col column container content foot group grid head id "
    "inner item items label left link links list lower main marker outer page pane panel post posts primary region right "
    "row secondary section site slot spot sticky tab tabs text title top unit upper view wrap wrapper zone".split()
)
#: Of HINTS, words that within an article name the head of its own.
OWN_HEAD = frozenset("header masthead".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")
TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:"[^"]*+"|'[^']*+'|[^'">])*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""",
    re.S,
)
HINTED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
SMOOTHING = ((-1, 0.25), (0, 0.5), (1, 0.25))
#: Least share of the best path's score that makes a path content.
THRESHOLD = 0.1
#: Factor on the score of what rarely is text; from so many characters on an element with over half
#: of the page's text outside links is spared it; least share of the text of the best article, or of
#: what is outside articles, that keeps another one.
PENALTY, SPARED_CHARS, SHARE = 0.05, 250, 0.5
#: Least share of the other text's ratio that lifts a doubt from a name that is not of layout alone.
LIFTS = 0.5


@dataclass(frozen=True)
class Path:
    """A tag path as its last step and the path above; compared by identity, so deep pages stay
    cheap. article: the outermost path above or here that ends in an article element. heading_in:
    what the first heading on the path stands in."""

    above: Path | None
    step: str
    article: Path | None
    heading_in: Path | None
    __hash__ = object.__hash__
    __eq__ = object.__eq__


ROOT = Path(None, "", None, None)


def fused_ratio(chars: int, nodes: int, marks: int) -> float:
    """Of characters outside links and marks of punctuation to text nodes."""
    return (chars / nodes * (1 + marks / nodes)) ** 0.5 if nodes else 0.0


def of_layout(name: str) -> bool | None:
    """Whether a class, id or role names layout: true if all its words do, none of HINTS apart; None
    if only some of them do; false without a word of HINTS."""
    parts = [p for p in re.split(r"[^a-z]+", name) if p]
    if not HINTS.intersection(parts):
        return False
    return True if all(p in HINTS or p in LAYOUT for p in parts) else None


@dataclass(eq=False)
class Doubt:
    """An element that rarely is text, the one around it, whether its name leaves that open; its
    characters outside links, text nodes, marks of punctuation and all characters."""

    above: Doubt | None
    open: bool = False
    chars: int = 0
    nodes: int = 0
    marks: int = 0
    all: int = 0
    counts: bool = False

    def add(self, chars: int, nodes: int, marks: int, all_: int) -> None:
        self.chars, self.nodes, self.marks, self.all = self.chars + chars, self.nodes + nodes, self.marks + marks, self.all + all_

    def ratio(self) -> float:
        return fused_ratio(self.chars, self.nodes, self.marks)


@dataclass
class Node:
    path: Path
    block: int
    text: str
    linked: bool
    doubt: Doubt | None = None

    @property
    def key(self) -> tuple[Path, bool]:
        return self.path, self.doubt is not None and self.doubt.counts


@dataclass
class _Open:
    """An open element: its name, path, whether it is left out, whether it is inside a link, the
    innermost element here or above that rarely is text."""

    tag: str
    path: Path
    out: bool
    linked: bool
    doubt: Doubt | None = None


@dataclass
class _Parser:
    nodes: list[Node] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=lambda: [_Open("", ROOT, False, False)])
    known: dict[tuple[Path, str], Path] = field(default_factory=dict)
    counts: Counter = field(default_factory=Counter)  # open elements by name
    block: int = 0
    doubts: list[Doubt] = field(default_factory=list)  # those around others before them

    def text(self, raw: str) -> None:
        top = self.stack[-1]
        if raw and not top.out:
            self.nodes.append(Node(top.path, self.block, html.unescape(raw), top.linked, top.doubt))

    def space(self) -> None:
        if self.nodes and self.nodes[-1].block == self.block:
            self.nodes[-1].text += " "

    def cut(self, at: int) -> None:
        self.counts.subtract(x.tag for x in self.stack[at:])
        del self.stack[at:]

    def path(self, above: Path, tag: str, step: str) -> Path:
        found = self.known.get((above, step))
        if found is None:
            heading_in = above.heading_in or (above if tag in HEADINGS else None)
            found = Path(above, step, above.article, heading_in)
            if found.article is None and tag in ARTICLE:
                object.__setattr__(found, "article", found)
            self.known[above, step] = found
        return found

    def end(self, tag: str) -> None:
        if self.counts[tag] > 0:
            at = len(self.stack) - 1
            while self.stack[at].tag != tag:
                at -= 1
            self.cut(at)

    def close_sibling(self, tag: str) -> None:
        for at in range(len(self.stack) - 1, 0, -1):
            open_ = self.stack[at].tag
            if open_ in SIBLINGS[tag]:
                self.cut(at)
                return
            if open_ in CONTAINERS:
                return

    def close_foreign(self) -> None:
        for at in range(len(self.stack) - 1, 0, -1):
            if self.counts["svg"] + self.counts["math"] <= 0 or self.stack[at].tag == "foreignobject":
                return
            if self.stack[at].tag in FOREIGN:
                self.cut(at)
                return

    def close_paragraph(self) -> None:
        if self.counts["p"] <= 0:
            return
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag == "p":
                self.cut(at)
                return
            if self.stack[at].tag in BLOCKS:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self.close_foreign()
            self.close_paragraph()
        if tag in SIBLINGS:
            self.close_sibling(tag)
        if tag in VOID:
            return
        top, names = self.stack[-1], []
        for found in HINTED.finditer(attributes):
            names += "".join(g or "" for g in found.groups()).lower().split()
        kinds = [of_layout(x) for x in names] if tag not in ARTICLE and tag not in ("html", "body") else []
        if top.path.article is not None:
            kinds = [k for k, x in zip(kinds, names, strict=True) if not OWN_HEAD.intersection(re.split(r"[^a-z]+", x))]
        rarely = tag in RARELY_TEXT or True in kinds or (tag == "header" and top.path.article is None)
        rarely = rarely or bool(attributes and HIDDEN.search(attributes))
        doubt = top.doubt
        if rarely or None in kinds:
            doubt = Doubt(doubt, open=not rarely)
            self.doubts.append(doubt)
        out = top.out or tag in NOT_TEXT
        step = f"{tag}.{re.split(r'[^a-z0-9]+', names[0])[0]}" if names and tag in BLOCKS else tag
        self.stack.append(_Open(tag, self.path(top.path, tag, step), out, top.linked or tag == "a", doubt))
        self.counts[tag] += 1


def text_nodes(page: str) -> list[Node]:
    """Text nodes in page order, without those of elements that hold no article text. A doubt counts
    unless most of the text is in its element."""
    parser, at = _Parser(), 0
    while True:
        token = TOKEN.search(page, at)
        parser.text(page[at : token.start()] if token else page[at:])
        if not token:
            break
        at = token.end()
        closing, tag, attributes = token.group(1, 2, 3) if token.group(2) else token.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            parser.block += 1
        elif tag in CELLS:
            parser.space()
        if closing:
            parser.end(tag)
        elif tag in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        else:
            parser.start(tag, attributes)
    _settle_doubts(parser.nodes, parser.doubts)
    return parser.nodes


def _settle_doubts(nodes: list[Node], doubts: list[Doubt]) -> None:
    """Which doubts count: not those in whose element most of the text is, nor those from a name that
    leaves it open if the element's ratio is like that of all text outside doubts."""
    total, others = 0, Doubt(None)
    for node in nodes:
        text = node.text.strip()
        if not text:
            continue
        sums = (0, 1, 0) if node.linked else (len(text), 1, len(PUNCTUATION.findall(text)))
        total += sums[0]
        (others if node.doubt is None else node.doubt).add(*sums, len(text))
    for doubt in reversed(doubts):
        if doubt.above is not None:
            doubt.above.add(doubt.chars, doubt.nodes, doubt.marks, doubt.all)
    least = LIFTS * others.ratio()
    for doubt in doubts:
        spared = doubt.chars >= SPARED_CHARS and 2 * doubt.chars > total
        spared = spared or doubt.open and 2 * doubt.chars >= doubt.all and doubt.ratio() >= least
        doubt.counts = not spared or doubt.above is not None and doubt.above.counts


Key = tuple[Path, bool]


def content_paths(nodes: list[Node]) -> set[Key]:
    """The paths whose smoothed, fused ratio of text and punctuation is not far below the best, each
    apart for nodes that rarely are text.

    Of articles and what is outside them, only those with much of the text found so stay. With them
    go the other paths of an article element that holds one, unless they are mostly links, and the
    headings beside one.
    """
    totals: dict[Key, list[int]] = {}
    for node in nodes:
        sums = totals.setdefault(node.key, [0, 0, 0, 0])
        sums[0] += 1
        sums[3] += len(node.text)
        if not node.linked:
            sums[1] += len(node.text)
            sums[2] += len(PUNCTUATION.findall(node.text))
    factor = {k: PENALTY if k[1] else 1 for k in totals}
    fused = {k: factor[k] * fused_ratio(chars, n, marks) for k, (n, chars, marks, _) in totals.items()}
    raw = [fused[node.key] for node in nodes]
    means: dict[Key, list[float]] = {}
    for i, node in enumerate(nodes):
        near = [(w, raw[i + d]) for d, w in SMOOTHING if 0 <= i + d < len(raw)]
        means.setdefault(node.key, []).append(sum(w * x for w, x in near) / sum(w for w, _ in near))
    smooth = {k: sum(x) / len(x) for k, x in means.items()}
    best = max(smooth.values(), default=0)
    # a neighbour's score alone does not make a path content: it needs text of its own
    chosen = {k for k, x in smooth.items() if best and x >= THRESHOLD * best and fused[k] >= THRESHOLD * best}
    weights: dict[Path | None, float] = {}
    for k in chosen:
        weights[k[0].article] = weights.get(k[0].article, 0) + factor[k] * totals[k][1]
    kept = {a for a, w in weights.items() if w >= SHARE * max(weights.values())}
    chosen = {k for k in chosen if k[0].article in kept}
    within = {k for k, (_, chars, _, all_) in totals.items() if 2 * chars >= all_ and not k[1] and k[0].article in kept - {None}}
    around: set[Path] = set()
    for p, _ in chosen:
        above = p.above
        while above is not None and above not in around:
            around.add(above)
            above = above.above
    return chosen | within | {k for k in totals if not k[1] and k[0].heading_in in around and k[0].article in kept}


def main_text(page: str | None) -> str:
    """The article of a page, its blocks joined by an empty line; null and empty pages give ""."""
    nodes = text_nodes(page or "")
    solid = [n for n in nodes if n.text.strip()]
    content = content_paths(solid)
    blocks: dict[int, list[str]] = {}
    wanted = {n.block for n in solid if n.key in content}
    for n in nodes:
        if n.block in wanted and (not n.key[1] or n.key in content):
            blocks.setdefault(n.block, []).append(n.text)
    return "\n\n".join(" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))


def extract_text(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` in place of the html.

    A null page is empty and gives an empty text. Each row is judged by itself, so repeated rows
    give the same. An empty table gives an empty result. Input columns named like the added ones
    give way to them.
    """
    kept = [c for c in pages.columns if c.lower() not in (html_column, "text", "n_chars")]
    fields = {f.name: f for f in pages.schema.fields}
    added = [StructField("text", StringType()), StructField("n_chars", LongType())]
    schema = StructType([*(fields[c] for c in kept), *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(len(kept))]
            columns = [*batch.columns[: len(kept)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return pages.select(*(name_of(c) for c in kept), name_of(html_column)).mapInArrow(run, schema)
