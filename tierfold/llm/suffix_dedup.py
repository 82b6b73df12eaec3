"""Exact repeats of 100 bytes and more, removed by sorted suffixes.

Sorting every suffix of a corpus would ship each byte a hundred times. Instead a hash of 32 bytes
marks, for every window of 100 bytes, one position inside it (the least hash); equal windows mark
equal positions. Windows of a mark whose 32 bytes occur once in the corpus are unique and done with.
The others travel to the other windows of their mark, and there their suffixes are ordered:
identical surroundings are collapsed first, then a multikey quicksort splits the suffixes by eight
bytes at a time down to a shallow depth, and blind tries order the groups that still agree. Windows
that turn out equal are all repeats but for the earliest.

In a run of a short period, such as a megabyte of blanks, the windows of a mark are those of the
mark before, one period on. These are repeats whatever else the corpus holds, so they leave the map
task as one span for a run and only the windows at its begin travel.

A mark that occurs very often is dealt over several tasks, by document and position. Each of them
settles its own windows; the earliest ones it found meet again by a 128-bit hash of their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierfold.llm.common import name_of, written

LENGTH, GRAM = 100, 32
WINDOW = LENGTH - GRAM + 1
#: Bytes that are hashed at once; positions within them take POSITION_BITS bits.
SEGMENT, POSITION_BITS = 1 << 20, 24
#: Bits of the filter of repeated marks that is broadcast: 16 MB whatever the corpus. More bits let
#: fewer unique marks through; those change no result.
FILTER_BITS, FILTER_PARTS = 27, 128
#: Rows of one mark in one task, and of one task.
MARK_ROWS, TASK_ROWS = 4096, 40_000
SHALLOW = 32
NULL_ID = 2**63 - 1


@cache
def _numbers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    odd = rng.integers(0, 2**64, 6, np.uint64) | np.uint64(1)
    return rng.integers(0, 2**64, 256, np.uint64), odd


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on, by doubling."""
    table, odd = _numbers()
    h, n = table[data], 1
    for k in range(GRAM.bit_length() - 1):
        h = h[:-n] * odd[k] + h[n:]
        n *= 2
    return (h ^ (h >> np.uint64(32))) * odd[5]


def marks(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, position, first window, last window) of each marked position of some bytes.

    ``valid`` lists, rising, where windows begin. Of equal hashes the leftmost is marked.
    """
    if not len(valid):
        return (np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3)))
    h = gram_hashes(data)
    low = np.uint64(POSITION_BITS)
    least = (h >> low) << low | np.arange(len(h), dtype=np.uint64)
    span = 1
    while 2 * span <= WINDOW:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = WINDOW - span
    least = np.minimum(least[: len(least) - rest], least[rest:])
    at = (least[valid] & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
    cut = np.flatnonzero((np.diff(at) != 0) | (np.diff(valid) != 1)) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut, [len(valid)]]) - 1
    return h[at[first]], at[first], valid[first], valid[last]


def own_repeats(data: bytes, begins: np.ndarray, found: tuple[np.ndarray, ...]) -> np.ndarray:
    """Whether all windows of each mark repeat those that lie before them by the distance from the
    mark before, in the same piece of text. ``begins``: where the pieces of ``data`` begin."""
    h, at, first, last = found
    step, out = np.diff(at, prepend=at[:1]), np.zeros(len(h), bool)
    near = np.flatnonzero((step > 0) & (h == np.roll(h, 1)))
    near = near[first[near] - step[near] >= begins[np.searchsorted(begins, first[near], "right") - 1]]
    for p in np.unique(step[near]).tolist():
        rows = near[step[near] == p]
        low, high = first[rows], last[rows] + LENGTH
        if len(rows) < 1000:
            out[rows] = [data[a:b] == data[a - p : b - p] for a, b in zip(low.tolist(), high.tolist(), strict=True)]
        else:
            bytes_ = np.frombuffer(data, np.uint8)
            differ = np.concatenate([[0], np.cumsum(bytes_[p:] != bytes_[:-p])])
            out[rows] = differ[high - p] == differ[low - p]
    return out


def _segments(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of several texts laid end to end: (bytes, starts of windows, begin of each text's
    piece, and where that piece begins in its text as (text, offset) rows)."""
    held: list[bytes] = []
    windows: list[np.ndarray] = []
    begins: list[int] = []
    origins: list[tuple[int, int]] = []
    size = 0
    for i, text in enumerate(texts):
        for offset in range(0, len(text) - LENGTH + 1, SEGMENT):
            piece = text[offset : offset + SEGMENT + LENGTH - 1]
            if size and size + len(piece) > SEGMENT + LENGTH:
                yield b"".join(held), np.concatenate(windows), np.array(begins), np.array(origins)
                held, windows, begins, origins, size = [], [], [], [], 0
            windows.append(np.arange(size, size + len(piece) - LENGTH + 1))
            begins.append(size)
            origins.append((i, offset))
            held.append(piece)
            size += len(piece)
    if held:
        yield b"".join(held), np.concatenate(windows), np.array(begins), np.array(origins)


def _all_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, valid, begins, _ in _segments(batch.column(2).to_pylist()):
            found = marks(np.frombuffer(data, np.uint8), valid)
            h = found[0][~own_repeats(data, begins, found)]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])


#: A row without bytes and with the mark RUN is a run of windows that are repeats already.
RUN = -1
CANDIDATES = "h LONG, doc LONG, k2 LONG, first LONG, windows INT, mark INT, bytes BINARY"


def _candidates(repeated: bytes, bits: int):
    """Marks that the filter lets through, with the bytes of their windows, and runs of repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.frombuffer(repeated.value, np.uint8)
        for batch in batches:
            docs, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for data, valid, begins, origins in _segments(batch.column(2).to_pylist()):
                h, at, first, last = found = marks(np.frombuffer(data, np.uint8), valid)
                gone = own_repeats(data, begins, found)
                run_first, run_last = _joined(first[gone], last[gone])
                slot = (h & np.uint64((1 << bits) - 1)).astype(np.int64)
                hit = (kept[slot >> 3] >> (slot & 7) & 1 == 1) & ~gone
                h, at, first, last = h[hit], at[hit], first[hit], last[hit]
                own = [data[a:b] for a, b in zip(first.tolist(), (last + LENGTH).tolist(), strict=True)]
                own += [b""] * len(run_first)
                mark = np.concatenate([at - first, np.full(len(run_first), RUN)])
                first, last = np.concatenate([first, run_first]), np.concatenate([last, run_last])
                piece = np.searchsorted(begins, first, "right") - 1
                text, offset = origins[piece, 0], origins[piece, 1]
                start = first - begins[piece] + offset
                spread = (k2[text] ^ start)[len(h) :]  # runs need no mark of theirs: they go to any task
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([h.view(np.int64), spread])),
                        pa.array(docs[text], pa.int64()),
                        pa.array(k2[text], pa.int64()),
                        pa.array(start, pa.int64()),
                        pa.array(last - first + 1, pa.int32()),
                        pa.array(mark, pa.int32()),
                        pa.array(own, pa.binary()),
                    ],
                    names=["h", "doc", "k2", "first", "windows", "mark", "bytes"],
                )

    return run


class BlindTrie:
    """Strings of one length under the positions where they branch; equal ones share a leaf."""

    def __init__(self):
        self.root = None  # leaf: (string, members); node: [position, {byte: child}]

    def insert(self, string: bytes, member: int) -> None:
        if self.root is None:
            self.root = (string, [member])
            return
        node, way = self.root, []
        while isinstance(node, list):  # blindly: only branching positions are looked at
            way.append(node)
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        if node[0] == string:
            node[1].append(member)
            return
        at = common_prefix(string, node[0])
        above = None
        for inner in way:
            if inner[0] >= at:
                below = inner
                break
            above = inner
        else:
            below = node
        if isinstance(below, list) and below[0] == at:
            below[1][string[at]] = (string, [member])
            return
        branch = [at, {node[0][at]: below, string[at]: (string, [member])}]
        if above is None:
            self.root = branch
        else:
            above[1][string[above[0]]] = branch

    def groups(self) -> Iterator[list[int]]:
        """Members of equal strings, in the order of the strings."""
        open_ = [self.root] if self.root is not None else []
        while open_:
            node = open_.pop()
            if isinstance(node, list):
                open_.extend(node[1][b] for b in sorted(node[1], reverse=True))
            else:
                yield node[1]


def common_prefix(a: bytes, b: bytes) -> int:
    """Bytes in which two strings of one length agree from the start."""
    differ = int.from_bytes(a) ^ int.from_bytes(b)
    return len(a) - (differ.bit_length() + 7) // 8


def deep_shallow(data: bytes, starts: np.ndarray, group: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Orders the strings of ``length`` bytes at ``starts`` within each group.

    Returns the order, and for each place in it the number of its class of equal strings.
    """
    n = len(starts)
    padded = np.frombuffer(data + b"\0" * 8, np.uint8)
    words = np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))
    order, cls = np.argsort(group, kind="stable"), np.sort(group, kind="stable")
    cls = np.concatenate([[0], np.cumsum(np.diff(cls) != 0)]) if n else cls
    for depth in range(0, SHALLOW, 8):  # multikey: groups are split by eight bytes at a time
        sizes = np.bincount(cls, minlength=1)
        open_ = np.flatnonzero(sizes[cls] > 1)
        if not len(open_):
            break
        key = words[starts[order[open_]] + depth]
        by = np.lexsort((key, cls[open_]))
        order[open_] = order[open_][by]
        key = key[by]
        new = np.zeros(n, bool)
        new[1:] = np.diff(cls) != 0
        inside = np.flatnonzero((np.diff(key) != 0) & (np.diff(cls[open_]) == 0)) + 1
        new[open_[inside]] = True
        cls = np.cumsum(new)
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(cls)) + 1, [n]]) if n else np.zeros(1, int)
    out = np.zeros(n, bool)
    out[bounds[:-1]] = True
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:
            trie = BlindTrie()
            for i in order[a:b].tolist():
                at = int(starts[i])
                trie.insert(data[at : at + length], i)
            place = a
            for members in trie.groups():
                out[place] = True
                order[place : place + len(members)] = members
                place += len(members)
    return order, np.cumsum(out) - 1


def _runs(row: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring windows of a row as (row, first, last)."""
    if not len(row):
        return row, window, window
    cut = np.flatnonzero((np.diff(row) != 0) | (np.diff(window) != 1)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(row)]]) - 1
    return row[first], window[first], window[last]


def _joined(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising ranges of windows, neighbouring ones as one."""
    if not len(first):
        return first, last
    cut = np.flatnonzero(first[1:] != last[:-1] + 1) + 1
    return first[np.concatenate([[0], cut])], last[np.concatenate([cut, [len(first)]]) - 1]


def merged(group: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each group in order, those that overlap or touch as one."""
    if not len(start):
        return group, start, end
    order = np.lexsort((start, group))
    group, start = group[order], start[order]
    above = group * (int(end.max()) + 1)  # ends of a later group are above those of an earlier one
    reach = np.maximum.accumulate(end[order] + above) - above
    new = np.flatnonzero((np.diff(group) != 0) | (start[1:] > reach[:-1])) + 1
    at = np.concatenate([[0], new])
    return group[at], start[at], reach[np.concatenate([new, [len(start)]]) - 1]


def _merged_spans(spans: pd.DataFrame) -> pd.DataFrame:
    """(doc, k2, first, end) with the spans of a document merged."""
    if not len(spans):
        return spans[["doc", "k2", "first", "end"]]
    keys, at = np.unique(spans[["doc", "k2"]].to_numpy(np.int64), axis=0, return_inverse=True)
    group, first, end = merged(at.reshape(-1), spans["first"].to_numpy(np.int64), spans["end"].to_numpy(np.int64))
    return pd.DataFrame({"doc": keys[group, 0], "k2": keys[group, 1], "first": first, "end": end})


FOUND = "doc LONG, k2 LONG, start LONG, end LONG, a LONG, b LONG"


def _settle(rows: pd.DataFrame) -> pd.DataFrame:
    """Repeats among the windows of some marks, as spans; for dealt marks also the windows that are
    the earliest here, with a hash (a, b) of their bytes."""
    rows = rows.sort_values(["doc", "k2", "first"], kind="stable").drop_duplicates(["doc", "k2", "first"])
    again = rows.duplicated(["h", "salt", "mark", "bytes"]) | (rows["mark"] == RUN)
    whole, rows = rows[again], rows[~again].reset_index(drop=True)
    spans = [whole[["doc", "k2", "first"]].assign(end=whole["first"] + whole["windows"] - 1 + LENGTH)]
    shared = rows.duplicated(["h", "salt"], keep=False).to_numpy() | (rows["salts"] > 1).to_numpy()
    rows = rows[shared].reset_index(drop=True)
    doc, k2, first = (rows[c].to_numpy() for c in ("doc", "k2", "first"))
    n, data = rows["windows"].to_numpy(np.int64), b"".join(rows["bytes"])
    base = np.concatenate([[0], np.cumsum(n + LENGTH - 1)[:-1]]) if len(rows) else n
    row = np.repeat(np.arange(len(rows)), n)
    window = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start, at = base[row] + window, first[row] + window
    # equal windows have their mark at the same place
    group = rows.groupby(["h", "salt"], sort=False).ngroup().to_numpy(np.int64)[row] * LENGTH
    order, cls = deep_shallow(data, start, group + rows["mark"].to_numpy(np.int64)[row] - window)
    order = order[np.lexsort((at[order], row[order], k2[row[order]], doc[row[order]], cls))]
    repeat = np.zeros(len(row), bool)
    repeat[order[np.flatnonzero(np.diff(cls) == 0) + 1]] = True
    r, low, high = _runs(row[repeat], window[repeat])
    spans.append(pd.DataFrame({"doc": doc[r], "k2": k2[r], "first": first[r] + low, "end": first[r] + high + LENGTH}))
    out = _merged_spans(pd.concat(spans)).rename(columns={"first": "start"})
    out = out.assign(a=pd.array([pd.NA] * len(out), "Int64"), b=pd.array([pd.NA] * len(out), "Int64"))
    open_ = np.flatnonzero(~repeat & (rows["salts"].to_numpy() > 1)[row]) if len(rows) else np.empty(0, int)
    digests = b"".join(xxhash.xxh3_128_digest(data[s : s + LENGTH]) for s in start[open_].tolist())
    hashes = np.frombuffer(digests, np.int64).reshape(-1, 2)
    r = row[open_]
    left = {"doc": doc[r], "k2": k2[r], "start": at[open_], "end": at[open_] + LENGTH, "a": hashes[:, 0], "b": hashes[:, 1]}
    left = pd.DataFrame(left).astype({"a": "Int64", "b": "Int64"})
    return pd.concat([out, left]) if len(left) else out


def _filter_part(rows: pd.DataFrame) -> pd.DataFrame:
    size = int(rows["size"].iloc[0])
    bits = np.zeros(size, np.uint8)
    bits[rows["slot"].to_numpy()] = 1
    return pd.DataFrame({"part": rows["part"][:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})


def _dealt(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """``candidates`` with the number of tasks ``salts`` of their mark and the one of each, ``salt``.

    Every mark of two tasks' rows and more is dealt. The table of these marks has no hint: it is
    written, so its size is known, and Spark broadcasts it while that is below the session's limit.
    """
    dealt = counts.where(F.col("n") >= 2 * MARK_ROWS)
    dealt = written(dealt.select("h", F.ceil(F.col("n") / MARK_ROWS).cast("int").alias("salts")), "dealt")
    candidates = candidates.join(dealt, "h", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    return candidates.withColumn("salt", F.pmod(F.xxhash64("doc", "k2", "first"), F.col("salts")).cast("int"))


def repeated_spans(docs: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc, k2, start, end): spans of repeated bytes, in any number and overlapping, of documents
    with the order key ``doc``, ``k2`` and ``bytes``."""
    spark = docs.sparkSession
    docs = docs.select("doc", "k2", "bytes").where(F.length("bytes") >= LENGTH)
    counts = docs.mapInArrow(_all_marks, "h LONG").groupBy("h").agg(F.count("*").alias("n"))
    counts = written(counts.where("n > 1"), "marks")
    total = counts.agg(F.sum("n")).first()[0] or 0
    size = (1 << filter_bits) // FILTER_PARTS
    slot = f"(h & {(1 << filter_bits) - 1})"
    slots = counts.selectExpr(f"CAST({slot} DIV {size} AS INT) AS part", f"CAST({slot} % {size} AS INT) AS slot", f"{size} AS size")
    parts = slots.distinct().groupBy("part").applyInPandas(_filter_part, "part INT, bits BINARY").collect()
    bits = bytearray(size * FILTER_PARTS // 8)
    for r in parts:
        bits[r["part"] * size // 8 : (r["part"] + 1) * size // 8] = r["bits"]
    candidates = docs.mapInArrow(_candidates(spark.sparkContext.broadcast(bytes(bits)), filter_bits), CANDIDATES)
    candidates = _dealt(candidates, counts)
    tasks = max(4 * spark.sparkContext.defaultParallelism, total // TASK_ROWS)
    task = F.pmod(F.xxhash64("h", "salt"), F.lit(tasks))
    # as many partitions as tasks, whatever the session's shuffle partitions
    candidates = candidates.withColumn("task", task).repartition(tasks, "task")
    found = written(candidates.groupBy("task").applyInPandas(_settle, FOUND), "repeats")
    spans = found.where("a IS NULL").select("doc", "k2", "start", "end")
    left = found.where("a IS NOT NULL")
    place = F.struct("doc", "k2", "start")
    earliest = left.groupBy("a", "b").agg(F.min(place).alias("earliest"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = left.join(written(earliest, "earliest"), ["a", "b"]).where(place != F.col("earliest"))
    return spans.union(later.select("doc", "k2", "start", "end"))


def _order_keys(doc_id: Column, text: Column) -> dict[str, Column]:
    return {"doc": F.coalesce(doc_id.cast("long"), F.lit(NULL_ID)), "k2": F.xxhash64(text)}


def suffix_dedup(docs: DataFrame, with_bytes: bool = True, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for each row of ``docs`` (doc_id, text).

    A byte goes if a string of LENGTH bytes that covers it also begins earlier: in a document of
    smaller id (null ids last; equal ids in the order of a hash of the text) or earlier in its own.
    A null text is empty. Rows that repeat both id and text are one document and lose the same
    bytes. ``kept`` holds the other bytes, and is null unless ``with_bytes``. An empty table gives an
    empty result.
    """
    text = F.coalesce(name_of("text").cast("string"), F.lit(""))
    keyed = docs.select(name_of("doc_id").cast("long").alias("doc_id"), F.encode(text, "UTF-8").alias("bytes"), *(c.alias(k) for k, c in _order_keys(name_of("doc_id"), text).items()))
    spans = repeated_spans(keyed, filter_bits).groupBy("doc", "k2").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = keyed.join(written(spans, "spans"), ["doc", "k2"], "left").select("doc_id", "bytes", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, data, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                data, gone = data.as_py(), []
                if spans.is_valid:
                    start, end = (spans.values.field(c).to_numpy() for c in ("start", "end"))
                    _, start, end = merged(np.zeros(len(start), np.int64), start, end)
                    gone = list(zip(start.tolist(), end.tolist(), strict=True))
                edges = [0, *(x for span in gone for x in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                digest = hashlib.sha256(kept).hexdigest()
                rows.append((doc_id, len(data), len(data) - len(kept), len(gone), digest, kept if with_bytes else None))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    return joined.mapInArrow(cut, "doc_id LONG, n_bytes LONG, n_removed LONG, n_spans LONG, kept_sha256 STRING, kept BINARY")
