"""Cost-balanced packing of documents into training sequences.

A sequence costs its tokens plus the squares of its pieces' lengths, as attention within documents
does. Documents in descending length go to the sequence of least cost that has room for them;
longer ones are cut into whole sequences first. There are just as many sequences as the tokens
fill, and what fits nowhere in one piece is cut, so no sequence has padding: the last tokens of a
chunk form sequences whose lengths are powers of two, which need none.

Each task tokenizes its documents and packs them chunk by chunk, a chunk having a bounded number of
tokens. Nothing is shuffled, and a task that is run again gives the same sequences.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierfold.llm.common import name_of, text_of

LENGTH, END_ID = 2048, 1
LINEAR, QUADRATIC = 1.0, 1 / 1024
CHUNK_TOKENS, OUT_ROWS = 2_000_000, 20_000
SCHEMA = (
    "doc_id LONG, start LONG, length LONG, ids_crc32 LONG, doc_tokens LONG, sequence_id LONG, offset LONG, ids BINARY"
)


class TokenIds:
    """Ids of the byte-level BPE of the public tokenizer files, as the tokenizer file gives them with
    ``add_special_tokens=False``: its added tokens are found in a text, too.

    The rank file of the same vocabulary gives the same ids several times faster; texts that are
    beyond its pattern matcher, such as a million blanks in a row, go to the tokenizer file itself.
    """

    def __init__(self, tokenizer: str, ranks: str):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            vocabulary = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        with open(tokenizer, encoding="utf-8") as file:
            added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        self._fast = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary, special_tokens=added
        )
        self._file = tokenizer

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self._fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return np.array(self._slow(text), np.uint32)

    def _slow(self, text: str) -> list[int]:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        return Tokenizer.from_file(self._file).encode(text, add_special_tokens=False).ids


@lru_cache(1)
def token_ids(tokenizer: str, ranks: str) -> TokenIds:
    return TokenIds(tokenizer, ranks)


def pack(lengths: np.ndarray, size: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of documents of these lengths."""
    pieces = [(d, s, size, 0, 0) for d, n in enumerate(lengths.tolist()) for s in range(0, n - size + 1, size)]
    pieces = [(d, s, n, k, 0) for k, (d, s, n, _, _) in enumerate(pieces)]
    first = len(pieces)
    whole = lengths // size * size
    rest = lengths - whole
    full, last = divmod(int(rest.sum()), size)
    room = np.array([size] * full + [1 << b for b in range(last.bit_length() - 1, -1, -1) if last >> b & 1], np.int64)
    used, cost = np.zeros(len(room), np.int64), np.zeros(len(room))
    for d in np.argsort(-rest, kind="stable").tolist():
        start, left = int(whole[d]), int(rest[d])
        while left:
            open_ = np.nonzero(room >= left)[0]
            k = int(open_[np.argmin(cost[open_])]) if len(open_) else int(np.argmax(room))
            n = min(left, int(room[k]))
            pieces.append((d, start, n, first + k, int(used[k])))
            room[k] -= n
            used[k] += n
            cost[k] += LINEAR * n + QUADRATIC * n * n
            start, left = start + n, left - n
    return pieces


def _rows(doc_ids: list, ids: list[np.ndarray], base: int, with_ids: bool) -> Iterator[tuple]:
    for d, start, n, sequence, offset in pack(np.array([len(x) for x in ids], np.int64)):
        raw = ids[d][start : start + n].astype("<u4").tobytes()
        yield doc_ids[d], start, n, zlib.crc32(raw), len(ids[d]), base + sequence, offset, raw if with_ids else None


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def packed(
    docs: DataFrame, tokenizer: str, ranks: str, with_ids: bool = True, chunk_tokens: int = CHUNK_TOKENS
) -> DataFrame:
    """Pieces of the sequences that hold all of ``docs`` (doc_id, text): see SCHEMA.

    ``ids`` are a piece's token ids as little-endian unsigned 32-bit numbers, left out (null) unless
    ``with_ids``; every document ends with END_ID. A null text is empty and has that id only. Rows
    that repeat an id are documents of their own. An empty table gives no pieces.
    """
    schema = pa.schema(
        [pa.field(f.split()[0], pa.binary() if f.endswith("BINARY") else pa.int64()) for f in SCHEMA.split(", ")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_ids(tokenizer, ranks)
        base, tokens = TaskContext.get().partitionId() << 40, 0
        doc_ids, ids, out = [], [], []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal base, tokens
            for row in _rows(doc_ids, ids, base, with_ids):
                out.append(row)
                if len(out) >= OUT_ROWS:
                    yield _batch(out, schema)
                    out.clear()
            base, tokens = base + tokens + 1, 0  # more than the sequences of the chunk
            doc_ids.clear()
            ids.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = np.append(encode(text.as_py()), np.uint32(END_ID))
                doc_ids.append(doc_id)
                ids.append(found)
                tokens += len(found)
                if tokens >= chunk_tokens:
                    yield from flush()
        if ids:
            yield from flush()
        if out:
            yield _batch(out, schema)

    return docs.select(name_of("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, SCHEMA)
