"""Counts against plain Python, and what the label model decides."""

import math
import random
import re
from collections import Counter

from tierfold.llm.quality_rules import (
    COUNTS,
    PRIOR,
    LabelModel,
    default_rules,
    fit_label_model,
    keep_good,
    quality_rules,
)

SCHEMA = "doc_id LONG, text STRING, kept INT, n_words STRING"


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counted = Counter(windows)
    repeat = {i + k for i, w in enumerate(windows) if counted[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeat)


def texts():
    rng = random.Random(3)
    out = ["", None, " \n\t", "a", "a a a", "a b a b a b", "x y z", "ü#|\n\n", "same\nsame\n\nsame", "\x0b\x0cq\r", "\x1c\x85w"]
    out.append("go " * 40_000)
    for _ in range(80):
        words = rng.choices([f"wörd{i}" for i in range(30)] + ["\n", "###"], k=rng.randrange(200))
        out.append(rng.choice([" ", "  ", "\t"]).join(words))
    out += [" ".join(f"word{i}" for i in range(n)) for n in (49, 50, 120)]
    return out


def test_counts_and_base_rule(spark):
    rows = [(i // 2, t, 1, "s") for i, t in enumerate(texts())]
    got = quality_rules(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    expected = Counter((i, t, *plain_counts(t)) for i, t, _, _ in rows)
    assert Counter((r.doc_id, r.text, *(r[c] for c in COUNTS)) for r in got) == expected
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def corpus():
    rng = random.Random(8)
    good = [" ".join(rng.choices([f"word{i}" for i in range(2000)], k=rng.randrange(110, 200))) for _ in range(120)]
    junk = [" ".join(rng.choices([f"wo{i}###" for i in range(2000)], k=rng.randrange(60, 200))) for _ in range(20)]
    return good, junk


def test_junk_goes_and_clean_text_stays(spark):
    good, junk = corpus()
    df = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(good + junk)], SCHEMA)
    kept = keep_good(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(len(good)))


def drawn(rng, rows, share, if_good, if_bad):
    for _ in range(rows):
        rates = if_good if rng.random() < share else if_bad
        yield tuple(rng.choices([-1, 0, 1], r)[0] for r in rates)


def fitted(spark, rows):
    columns = list("abcde")[: len(rows[0])]
    return fit_label_model(spark.createDataFrame(rows, ", ".join(f"{c} INT" for c in columns)), columns)


def test_label_model_is_a_maximum(spark):
    """The estimate from pattern counts is that of plain expectation-maximisation over rows."""
    rows = list(drawn(random.Random(1), 400, 0.8, [(0.005, 0.3, 0.695)] * 4, [(0.5, 0.3, 0.2)] * 4))
    model = fitted(spark, rows)
    posterior = [model.probability(v) for v in rows]
    prior, start = PRIOR * len(rows), LabelModel.start(4)
    assert math.isclose(model.share, (sum(posterior) + prior * start.share) / (len(rows) + prior), abs_tol=1e-4)
    assert 0.6 < model.share < 0.9
    assert (model.if_good[0], model.if_bad[0]) == (start.if_good[0], start.if_bad[0])  # the anchor's
    for j in range(1, 4):
        for rates, first, weight in (
            (model.if_good, start.if_good, posterior),
            (model.if_bad, start.if_bad, [1 - p for p in posterior]),
        ):
            for vote in (-1, 0, 1):
                seen = sum(w for w, v in zip(weight, rows, strict=True) if v[j] == vote)
                rate = (seen + prior * first[j][vote + 1]) / (sum(weight) + prior)
                assert math.isclose(rates[j][vote + 1], rate, abs_tol=1e-4)
    assert model.probability((-1, -1, -1, -1)) < 0.01 < 0.9 < model.probability((1, 1, 1, 1))


def test_planted_accuracies_come_back(spark):
    if_good = [(0.01, 0.05, 0.94), (0.2, 0.2, 0.6), (0.05, 0.55, 0.4), (0.02, 0.08, 0.9)]
    if_bad = [(0.6, 0.3, 0.1), (0.22, 0.2, 0.58), (0.5, 0.4, 0.1), (0.6, 0.1, 0.3)]
    model = fitted(spark, list(drawn(random.Random(5), 8000, 0.75, if_good, if_bad)))
    assert abs(model.share - 0.75) < 0.05
    for found, planted in ((model.if_good[1:], if_good[1:]), (model.if_bad[1:], if_bad[1:])):
        assert all(abs(f - p) < 0.05 for a, b in zip(found, planted, strict=True) for f, p in zip(a, b, strict=True))
    assert model.probability((1, -1, 1, 1)) > 0.9  # the second rule tells nothing
    assert model.probability((0, 0, -1, 0)) < 0.5


def test_clean_text_alone_stays(spark):
    """Without bad text, rules that now and then vote bad on good text drop none of it."""
    if_good = [(0.001, 0.09, 0.909)] + [(0.01, 0.09, 0.9)] * 4
    rows = list(drawn(random.Random(6), 4000, 1.0, if_good, [(1, 1, 1)] * 5))
    model = fitted(spark, rows)
    assert model.share > 0.98
    assert all(model.probability(v) > 0.5 for v in rows if sum(x < 0 for x in v) < 2)


def test_votes_decide_together(spark, testdata="/root/testdata/sf0.01"):
    got = quality_rules(spark.read.parquet(f"{testdata}/documents.parquet"), carry=["doc_id"])
    votes = [f"vote_{r.name}" for r in default_rules()]
    rows = [r for r in got.collect() if not r.base_failed]
    assert any(r.kept and any(r[v] < 0 for v in votes) for r in rows)
    assert any(not r.kept and all(r[v] >= 0 for v in votes) for r in rows)
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{testdata}/labels.parquet").collect()}
    told = [(r.kept, label[r.doc_id] == 1) for r in rows if r.doc_id in label]
    assert sum(kept == good for kept, good in told) > 0.99 * len(told)


def test_empty_table_and_repeats(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert quality_rules(df).collect() == [] and keep_good(df).collect() == []
    good, _ = corpus()
    twice = spark.createDataFrame([(1, good[0], None, None)] * 3, SCHEMA)
    assert keep_good(twice).count() == 3
    assert len(default_rules()) <= 8  # 3**rules patterns reach the driver
