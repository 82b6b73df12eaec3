"""Few sequences: combinations against all subsets, pieces against the tokenizer library."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tierfold.llm.bin_slack import combinations, fullest, places, slack_packed

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id LONG, text STRING, length INT, task STRING, sequence_id INT"


def test_fullest_of_all_subsets():
    rng = random.Random(1)
    for _ in range(300):
        room = rng.randrange(40)
        items = [rng.randrange(1, 25) for _ in range(rng.randrange(9))]
        sums = {sum(c) for n in range(len(items) + 1) for c in itertools.combinations(items, n)}
        used = fullest(Counter(items), room)
        assert sum(x * n for x, n in used) == max(s for s in sums if s <= room)
        assert all(Counter(items)[x] >= n > 0 for x, n in used)


def test_as_one_sequence_after_the_other():
    """Taking a combination out many times at once is what filling one by one comes to."""
    rng = random.Random(2)
    for _ in range(60):
        size = rng.choice([20, 64])
        left = Counter(rng.choice([3, 5, 7, 11, 12, 19]) for _ in range(rng.randrange(1, 60)))
        plan = combinations(dict(left), size)
        each = [used for times, used in plan for _ in range(times)]
        assert sum((Counter(dict(u)) for u in each), Counter()) == left
        by_longest, by_all = [], []
        for bins, with_longest in ((by_longest, True), (by_all, False)):
            rest = Counter(left)
            while rest := +rest:
                longest = [max(rest)] if with_longest else []
                used = Counter(dict(fullest(rest - Counter(longest), size - sum(longest)))) + Counter(longest)
                bins.append(sorted(used.items(), reverse=True))
                rest -= used
        assert each in (by_longest, by_all) and len(each) == min(len(by_longest), len(by_all))


def test_places_are_gapless():
    counts = {1: 9000, 2: 3, 700: 40, 1024: 7, 1500: 11, 2048: 5, 2047: 2}
    plan = combinations(counts)
    runs, held = places(plan), defaultdict(list)
    for length, n in counts.items():
        key = (length << 48) + np.arange(n)
        at = np.searchsorted(runs["key"], key, side="right") - 1
        k = key - runs["key"][at]
        for s, o in zip(runs["sequence"][at] + k // runs["used"][at], runs["offset"][at] + k % runs["used"][at] * length):
            held[int(s)].append((int(o), length))
    assert sorted(held) == list(range(sum(times for times, _ in plan)))
    for spans in held.values():
        assert [o for o, _ in sorted(spans)] == [0, *itertools.accumulate(n for _, n in sorted(spans))][:-1]


def test_few_combinations_for_any_counts():
    rng = random.Random(3)
    counts = {x: rng.choice([1, 3, 50, 10**9]) for x in range(1, 2049)}
    plan = combinations(counts)
    assert len(plan) < 10_000
    tokens = sum(x * n for x, n in counts.items())
    assert sum(times for times, _ in plan) <= tokens / 2048 * 1.02


def test_pieces_hold_all_ids_once(spark):
    rng = random.Random(4)
    odd = [None, "", " ", "a  b\t\n c", "été　größe 日本 \U0001f600", "x <|endoftext|><|endoftext|> don't", " " * 600_000, "x" * 5000]
    texts = odd + [" ".join(rng.choices(["the", "Of.", "naïve", "\n", "x1"], k=rng.choice([5, 900, 9000]))) for _ in range(60)]
    texts += [texts[10]] * 40  # copies: one length that many documents share
    rows = [(None if i == 3 else 2**60 + i // 2, t, i, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = slack_packed(docs, *FILES).collect()
    tokenizer = Tokenizer.from_file(FILES[0])
    expected = defaultdict(Counter)
    for doc_id, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids), 2048), len(ids)]
        for piece, (start, end) in enumerate(itertools.pairwise(cuts)):
            expected[doc_id][piece, start, tuple(ids[start:end])] += 1
    pieces, held, tokens = defaultdict(Counter), defaultdict(list), 0
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.length == len(ids) and r.ids_crc32 == zlib.crc32(r.ids)
        pieces[r.doc_id][r.piece, r.start, tuple(ids)] += 1
        held[r.sequence_id].append((r.offset, r.length))
        tokens += r.length
    assert pieces == expected
    for spans in held.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(held) <= tokens / 2048 + 2
    again = slack_packed(docs, *FILES, with_ids=False).drop("ids").collect()
    key = lambda r: str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.sequence_id, r.offset))
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_empty_table(spark):
    assert slack_packed(spark.createDataFrame([], SCHEMA), *FILES).collect() == []
