"""Packing of documents into few sequences by minimum bin slack.

A sequence is filled with the combination of available lengths that leaves the least room: a dynamic
programme over subset sums, held as the bits of one number, finds it and the lengths are taken out.
Only the number of documents of each length matters for that, at most one count for each length up
to that of a sequence, whatever the corpus. A combination is taken out as often as the counts allow,
which is what filling one sequence after the other comes to, since the same combination is found
again for as long as it is there. So all documents are packed together: tasks tokenize and count,
the driver turns the counts into combinations, and each document finds its place from its rank among
those of its length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierfold.llm.common import name_of, text_of, written
from tierfold.llm.packing import token_ids

LENGTH, END_ID, OUT_ROWS = 2048, 0, 20_000
PIECES = "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG, task INT, nth LONG, ids BINARY"

#: How often a combination is taken out, and its lengths with the number of times each is in it.
Combination = tuple[int, list[tuple[int, int]]]


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, how many) of the available lengths that together fill ``room`` best.

    Bit s of ``sums`` says that a combination of the lengths so far has the sum s. Lengths come
    longest first, a count in parts of 1, 2, 4, ...; nothing is fuller than a full sequence, so it
    stops at the first one. Among equal sums, the longer lengths are used.
    """
    sums, within, steps = 1, (1 << room + 1) - 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left and not sums >> room & 1:
            part = min(part, left)
            steps.append((length, part, sums))
            sums |= sums << part * length & within
            left, part = left - part, 2 * part
        if sums >> room & 1:
            break
    at, used = sums.bit_length() - 1, Counter()
    for length, part, before in reversed(steps):
        if not before >> at & 1:
            at -= part * length
            used[length] += part
    return sorted(used.items(), reverse=True)


def _combinations(counts: dict[int, int], size: int, with_longest: bool) -> list[Combination]:
    left, found = dict(counts), []
    while left:
        if with_longest:
            longest = max(left)
            rest = {x: n - (x == longest) for x, n in left.items() if n > (x == longest)}
            used = Counter(dict(fullest(rest, size - longest)))
            used[longest] += 1
        else:
            used = Counter(dict(fullest(left, size)))
        times = min(left[x] // n for x, n in used.items())
        found.append((times, sorted(used.items(), reverse=True)))
        for x, n in used.items():
            left[x] -= times * n
            if not left[x]:
                del left[x]
    return found


def combinations(counts: dict[int, int], size: int = LENGTH) -> list[Combination]:
    """Combinations that use up ``counts`` (length: number), by whichever leads to fewer sequences:
    the fullest one of all that is left, or the fullest one that holds the longest length left.

    Taking one out as often as possible leaves one of its lengths fewer times than it is in it, so
    there are at most a few for each length, some 19,000 for lengths up to 2048.
    """
    plans = [_combinations(counts, size, with_longest) for with_longest in (True, False)]
    return min(plans, key=lambda plan: sum(times for times, _ in plan))


def places(plan: list[Combination]) -> dict[str, np.ndarray]:
    """Runs of ranks among the pieces of a length, in order of length and rank: run i starts at
    ``key`` = length * 2^48 + rank; its k-th piece stands in sequence ``sequence`` + k // ``used``
    at ``offset`` + k % ``used`` * length."""
    rows, taken, sequence = [], Counter(), 0
    for times, used in plan:
        offset = 0
        for length, n in used:
            rows.append(((length << 48) + taken[length], sequence, n, offset))
            taken[length] += times * n
            offset += n * length
        sequence += times
    return dict(zip(("key", "sequence", "used", "offset"), np.array(sorted(rows), np.int64).reshape(-1, 4).T, strict=True))


def _pieces(tokenizer: str, ranks: str, size: int, with_ids: bool):
    schema = pa.schema(
        [
            pa.field(name, {"LONG": pa.int64(), "INT": pa.int32(), "BINARY": pa.binary()}[kind])
            for name, kind in (f.split() for f in PIECES.split(", "))
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, met, out = token_ids(tokenizer, ranks), TaskContext.get().partitionId(), Counter(), []

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for documents in batches:
            for doc_id, text in zip(documents.column(0).to_pylist(), documents.column(1), strict=True):
                ids = np.append(encode(text.as_py()), END_ID).astype("<u4")
                starts = [0, *range((len(ids) - 1) % size + 1, len(ids), size)]
                for piece, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    raw = ids[start:end].tobytes()
                    n = end - start
                    out.append((doc_id, piece, start, n, zlib.crc32(raw), task, met[n], raw if with_ids else None))
                    met[n] += 1
                if len(out) >= OUT_ROWS:
                    yield batch()
        if out:
            yield batch()

    return run


def _placed(runs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = runs.value
        for rows in batches:
            length = rows.column("length").to_numpy()
            key = (length << 48) + rows.column("nth").to_numpy()
            at = np.searchsorted(of["key"], key, side="right") - 1
            k, used = key - of["key"][at], of["used"][at]
            columns = {c: rows.column(c) for c in rows.schema.names if c != "nth"}
            sequence, offset = of["sequence"][at] + k // used, of["offset"][at] + k % used * length
            yield pa.RecordBatch.from_pydict({**columns, "sequence_id": sequence, "offset": offset})

    return run


def slack_packed(docs: DataFrame, tokenizer: str, ranks: str, with_ids: bool = True, size: int = LENGTH) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset) of all pieces of ``docs``
    (doc_id, text) in sequences of at most ``size`` tokens.

    A document is its token ids and END_ID; only longer ones are cut, into pieces of ``size`` tokens,
    of which the first may be shorter. ``ids`` are a piece's ids as little-endian unsigned 32-bit
    numbers, null unless ``with_ids``. A null text is empty and has END_ID only; very long texts are
    pieces like others. Rows that repeat an id or all of a row are documents of their own; a null id
    stays null. Other columns are not looked at. An empty table gives no pieces.
    """
    texts = docs.select(name_of("doc_id").cast("long"), text_of().alias("text"))
    pieces = written(texts.mapInArrow(_pieces(tokenizer, ranks, size, with_ids), PIECES), "pieces")
    met = written(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    counts = met.groupBy("length").agg(F.sum("n")).collect()  # at most ``size`` rows
    runs = docs.sparkSession.sparkContext.broadcast(places(combinations({x: n for x, n in counts}, size)))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = met.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["length", "task"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    ranked = ranked.select(*columns, (F.col("nth") + F.col("before")).alias("nth"))
    schema = "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG, ids BINARY, sequence_id LONG, offset LONG"
    return ranked.mapInArrow(_placed(runs), schema)
