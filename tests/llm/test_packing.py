"""Pieces against the tokenizer library and the rules of a packing."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tierfold.llm.packing import pack, packed

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id LONG, text STRING, length INT"


def sequences_are_full(pieces):
    held = defaultdict(list)
    for sequence, offset, length in pieces:
        held[sequence].append((offset, length))
    for spans in held.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end and length > 0
            end += length
        assert end <= 2048 and end & (end - 1) == 0
    return len(held)


def test_pack_fills_every_sequence():
    rng = random.Random(2)
    for n in (0, 1, 7, 300):
        lengths = np.array([rng.choice([1, 30, 700, 2048, 9000]) + rng.randrange(50) for _ in range(n)], np.int64)
        pieces = pack(lengths)
        covered = defaultdict(int)
        for d, start, length, _, _ in sorted(pieces):
            assert start == covered[d]
            covered[d] += length
        assert [covered[d] for d in range(n)] == lengths.tolist()
        count = sequences_are_full([(s, o, length) for _, _, length, s, o in pieces])
        assert count <= lengths.sum() / 2048 + 11


def test_costs_are_balanced():
    lengths = np.array([64] * 320 + [1024] * 20, np.int64)
    cost = defaultdict(float)
    for _, _, n, sequence, _ in pack(lengths):
        cost[sequence] += n * n
    assert max(cost.values()) <= 2 * 1024**2


def test_pieces_hold_all_ids_once(spark):
    rng = random.Random(4)
    odd = [None, "", " ", "a  b\t\n c", "été　größe 日本 \U0001f600", "<|endoftext|> don't 123", "a <|endoftext|><|endoftext|>b <|endoftext|", "<|endoftext|>" + " " * 600_000, "x" * 5000]
    texts = odd + [" ".join(rng.choices(["the", "Of.", "naïve", "\n", "x1"], k=rng.choice([5, 900, 9000]))) for _ in range(60)]
    rows = [(None if i == 3 else i // 2, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = packed(docs, *FILES, chunk_tokens=20_000).collect()
    tokenizer = Tokenizer.from_file(FILES[0])
    expected = defaultdict(list)
    for doc_id, text, _ in rows:
        expected[doc_id].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])
    sequences_are_full([(r.sequence_id, r.offset, r.length) for r in got])
    pieces = defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.length == len(ids) and r.ids_crc32 == zlib.crc32(r.ids)
        pieces[r.doc_id].append((r.start, ids, r.doc_tokens))
    for doc_id, documents in expected.items():
        assert sum(len(ids) for _, ids, _ in pieces[doc_id]) == sum(map(len, documents))
        for start, ids, n in pieces[doc_id]:
            assert any(len(d) == n and d[start : start + len(ids)] == ids for d in documents)
    again = packed(docs, *FILES, with_ids=False, chunk_tokens=20_000).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r[:7])
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_empty_table(spark):
    assert packed(spark.createDataFrame([], SCHEMA), *FILES).collect() == []
