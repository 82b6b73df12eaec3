"""Templates against the SQL twin's rule written out in Python."""

import random
import re
from collections import defaultdict

from tierfold.llm.line_dedup import documents_without_lines, line_dedup

SCHEMA = "doc_id LONG, text STRING, n_lines STRING, gone INT, n_chars LONG"


def words(line):
    return re.findall(r"[^\x20\x09-\x0D]+", line)


def mask(word):
    return "<*>" if re.search("[0-9]", word) else word


def plain(docs, depth=3, least=5):
    """{doc_id: (text, n_lines, n_dropped)} for documents with ids of their own."""
    lines = [(i, k, line) for i, t in docs if t is not None for k, line in enumerate(t.split("\n"))]
    equal = defaultdict(list)
    for i, k, x in lines:
        if words(x):
            equal[x].append((i, k))
    lines = [(i, k, x, (len(words(x)), *map(mask, words(x)[:depth]))) for i, k, x in lines if len(words(x)) >= 5]
    in_leaf = defaultdict(set)
    for i, _, _, leaf in lines:
        in_leaf[leaf].add(i)
    lines = [x for x in lines if len(in_leaf[x[3]]) >= least]
    documents = defaultdict(set)
    for i, _, x, leaf in lines:
        documents[leaf, x].add(i)
    support = defaultdict(int)
    for (leaf, x), ids in documents.items():
        for at, w in enumerate(words(x)):
            support[leaf, at, mask(w)] += len(ids)
    templates, found = {}, defaultdict(list)
    for leaf, x in documents:
        shown = [w if mask(w) == w and support[leaf, at, w] >= least else "<*>" for at, w in enumerate(words(x))]
        real = sum(mask(w) == w and support[leaf, at, w] >= least for at, w in enumerate(words(x)))
        if real >= 0.5 * len(shown):
            templates[leaf, x] = (leaf, *shown)
    for i, k, x, leaf in lines:
        if (leaf, x) in templates:
            found[templates[leaf, x]].append((i, k))
    gone = set()
    for places in equal.values():
        if len({i for i, _ in places}) >= 2:
            gone |= set(places) - {min(places)}
    for places in found.values():
        if len({i for i, _ in places}) >= least:
            gone |= set(places) - {min(places)}
    out = {}
    for i, t in docs:
        all_ = [] if t is None else t.split("\n")
        left = [x for k, x in enumerate(all_) if (i, k) not in gone]
        out[i] = (None if t is None else "\n".join(left), len(all_), len(all_) - len(left))
    return out


def make(n=120):
    rng = random.Random(11)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in "uvwxyz"] + ["x1", "22"]
    license_ = "Licensed under the Example License version 2"
    docs = []
    for i in range(n):
        lines = [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 14))) for _ in range(rng.randrange(5))]
        if rng.random() < 0.5:
            lines.insert(rng.randrange(len(lines) + 1), license_)
        if rng.random() < 0.4:
            lines.append(f"Page {rng.randrange(99)} of {rng.choice(vocabulary)} was printed by user{i} on demand")
        if rng.random() < 0.2:
            lines += [f"  {license_}\t", license_]
        docs.append((3 * i, rng.choice(["\n", "\n\n"]).join(lines)))
    return docs + [(1, None), (2, ""), (4, "\n\n"), (5, "long word line " * 20_000)]


def test_against_plain(spark):
    docs = make()
    df = spark.createDataFrame([(*d, "s", 1, 0) for d in docs], SCHEMA).repartition(4)
    got = line_dedup(df)
    assert sorted(got.columns) == sorted(df.columns + ["n_dropped"])
    expected = plain(docs)
    assert {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in got.collect()} == expected
    assert sum(d for _, _, d in expected.values()) > 80


def test_the_first_line_of_a_template_stays(spark):
    line = "This line stands in many documents."
    rows = [(i, f"{line}\nown words of number{i}", None, None, 7) for i in range(9, 1, -1)]
    got = documents_without_lines(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == spark.createDataFrame(rows, SCHEMA).columns
    found = {r.doc_id: r for r in got.collect()}
    assert found[2].text.startswith(line) and found[2].n_chars == len(found[2].text)
    assert all(found[i].text == f"own words of number{i}" for i in range(3, 10))


def test_equal_lines_recur_from_two_documents_on(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    texts = [f"{passage}\nHi.", f"a b\n{passage}\n \nHi.", "x y z\nx y z\n \na  b", passage.replace("word7", "other")]
    rows = [(i, t, None, None, len(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: (texts[0], 0), 1: ("a b\n ", 2), 2: (texts[2], 0), 3: (texts[3], 0)}


def test_null_ids_repeated_rows_and_no_rows(spark):
    line = "one two three four five six"
    rows = [(None, line + "\na", None, 1, 1)] * 2 + [(i, line + f"\n{i}", None, 1, 1) for i in range(6)]
    got = line_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id is None, r.text) for r in got) == sorted(
        [(True, "a")] * 2 + [(False, str(i)) for i in range(1, 6)] + [(False, line + "\n0")]
    )
    assert line_dedup(spark.createDataFrame([], SCHEMA)).collect() == []
