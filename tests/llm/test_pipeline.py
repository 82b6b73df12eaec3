"""Every stage of the pipeline against plain Python over what the stage before kept."""

import random
from collections import Counter, defaultdict

import pytest
from test_line_dedup import plain as plain_lines
from test_mixing import n_words, plain_targets
from test_packing import FILES, sequences_are_full
from test_quality_rules import plain_counts
from test_simhash import plain_components, plain_simhash
from tokenizers import Tokenizer

import corpus_pipeline
from tierfold.llm.common import written

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


def corpus():
    rng = random.Random(21)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrst"] + ["The", "was"]
    rows = []
    for _ in range(150):
        lines = [" ".join(rng.choices(vocabulary, k=rng.randrange(5, 40))).capitalize() + "." for _ in range(rng.randrange(2, 9))]
        if rng.random() < 0.3:
            lines.append("All of these words stand here under a license of ours")
        if rng.random() < 0.1:
            lines = [" ".join(w + "###" for w in line.split()) for line in lines]
        text = "\n".join(lines)
        rows += [text] * rng.choice([1, 1, 1, 1, 2, 9])
        if rng.random() < 0.1:
            rows.append(text.replace("a", "A"))
    rows += [None, "", "too short"]
    rng.shuffle(rows)
    sources = ["hot"] * 6 + ["a", "b", "c", None]
    return [(i, t, "en", rng.choice(sources), None if t is None else len(t)) for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA).repartition(3)
    out = [docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, "unused"), f"step{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        out.append(docs.collect())
    return out


def test_quality_keeps_clean_documents_whole(steps):
    before = {r.doc_id: r for r in steps[0]}
    kept = {r.doc_id for r in steps[1]}
    assert all(before[r.doc_id] == r for r in steps[1])
    for i, r in before.items():
        words, _, symbols, _, repeat = plain_counts(r.text)
        fails = words < 50 or 100 * repeat > 50 * words or symbols > 0.5 * words
        assert fails == (i not in kept)


def test_lines(steps):
    expected = plain_lines([(r.doc_id, r.text) for r in steps[1]])
    assert {r.doc_id: r.text for r in steps[2]} == {i: t for i, (t, _, _) in expected.items()}
    assert all(r.n_chars == len(r.text) for r in steps[2])


def test_one_of_each_group(steps):
    rows = sorted(steps[2], key=lambda r: r.doc_id)
    roots = plain_components([plain_simhash(r.text) for r in rows], lambda a, b: bin(a ^ b).count("1") <= 4)
    assert sorted(r.doc_id for r in steps[3]) == [rows[i].doc_id for i in sorted(set(roots))]
    assert len(steps[3]) < len(steps[2])


def test_mixture(steps):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in steps[3]:
        sizes[r.source] += n_words(r.text)
    for r in steps[4]:
        taken[r.source] += n_words(r.text)
    assert taken == {s: int(t + 1e-6) for s, t in plain_targets(sizes).items()}
    texts = {r.doc_id: r.text for r in steps[3]}
    assert all(texts[r.doc_id].startswith(r.text) for r in steps[4])


def test_sequences(steps):
    tokenizer = Tokenizer.from_file(FILES[0])
    expected = Counter()
    for r in steps[4]:
        expected[r.doc_id] += len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1
    got = Counter()
    for r in steps[5]:
        got[r.doc_id] += r.length
    assert got == expected
    sequences_are_full([(r.sequence_id, r.offset, r.length) for r in steps[5]])


def test_run_joins_the_stages(spark, tmp_path, steps):
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sum(r.length for r in rows) == sum(r.length for r in steps[5])
