"""Fingerprints, anchors and groups against plain Python over all pairs."""

import random
import re

import numpy as np
import xxhash

from tierfold.llm.simhash import BLOCKS, LENGTH, anchors, keep_one_of_each, simhash, simhash_dedup


def plain_simhash(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, linked):
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(values))]


def texts(n, seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}É" for i in range(40)] + ["THE", "Of", "and"]
    out = ["", " \t\n", None, "One", "one two three", "a b c d e"]
    while len(out) < n:
        words = rng.choices(vocabulary, k=rng.choice([3, 30, 200]))
        out.append(" ".join(words))
        for _ in range(rng.choice([0, 0, 1, 3])):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "edited"
            out.append("\n".join(copy))
    return out[:n]


def test_fingerprint():
    for t in texts(60) + ["x " * 70000]:
        assert simhash((t or "").encode()) & (2**64 - 1) == plain_simhash(t)


def test_every_pair_within_one_bit_of_a_block_meets_at_a_home():
    rng = np.random.default_rng(1)
    for _, length in BLOCKS:
        x = rng.integers(0, 1 << length, 300)
        y = x ^ (1 << rng.integers(0, length, 300))
        homes = {}
        for i, a, home in zip(*anchors(x), strict=True):
            assert bin(x[i] ^ a).count("1") <= 4
            if home:
                assert i not in homes and bin(x[i] ^ a).count("1") <= 3
                homes[i] = a
        meets = set(zip(*(v.tolist() for v in anchors(y)[:2]), strict=True))
        assert all((i, homes[i]) in meets for i in range(300))
    assert LENGTH == 23


def test_groups_are_those_of_all_pairs(spark):
    rows = [(i * 3, t) for i, t in enumerate(texts(300))]
    rng = random.Random(3)
    rng.shuffle(rows)
    found = simhash_dedup(spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(5)).collect()
    prints = [plain_simhash(t) for _, t in rows]
    roots = plain_components(prints, lambda a, b: bin(a ^ b).count("1") <= 4)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        least[r] = min(i, least.get(r, i))
    expected = {i: (f"{p:016x}", least[r]) for (i, _), p, r in zip(rows, prints, roots, strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == expected
    assert len(set(least.values())) < 250


def test_one_of_each_stays_with_its_columns(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(None, text, 1), (7, text, 2), (7, text, 3), (9, text.upper(), 4), (1, "other words here now ok", 5)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, simhash INT")
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 7]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id LONG, text STRING")
    assert simhash_dedup(docs).collect() == [] and keep_one_of_each(docs).collect() == []
