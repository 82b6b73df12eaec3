"""SimHash near-duplicates, found around the anchors of a covering code.

The 64 bits are cut into three blocks. If two fingerprints differ in at most four bits, they differ
in at most one bit of some block. The anchors of a block are the words of the binary Golay code of
length 23 (shorter blocks are padded with zeros): every block is within three bits of exactly one
anchor, its home. A fingerprint is copied to every anchor within four bits, the covering radius plus
the block's threshold, so it meets, at the home anchor of any partner, that partner. Fingerprints
are compared in full at each anchor, and what they link there is reduced to a spanning forest before
it leaves the task. No link is missed, and none is made above the bit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tierfold.llm.common import name_of, written
from tierfold.llm.components import components, spanning_edges

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: First bit and length of the blocks of a fingerprint.
BLOCKS = [(0, 22), (22, 21), (43, 21)]
#: The generator polynomial of the binary Golay code of length 23.
GOLAY, LENGTH, CHECK_BITS, RADIUS = 0b110001110101, 23, 11, 3
#: Rows of one anchor that meet in one cell at most; more are dealt over a grid of cells.
HOMES, GUESTS, CELL_ROWS = 2048, 4096, 100_000


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text as a signed number: a bit is 1 if it is set in over half of
    the 64-bit hashes of the shingles, repeats included. No words give 0."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = min(shingle, len(words)) - 1
    starts, ends = starts[: len(words) - last], ends[last:]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        cut = slice(at, at + (1 << 16))
        parts = map(joined.__getitem__, map(slice, starts[cut].tolist(), ends[cut].tolist()))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, len(starts[cut]))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_ = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(set_.view(np.int64)[0])


def with_fingerprint(df: DataFrame, text: str = "text", shingle: int = SHINGLE, name: str = "simhash") -> DataFrame:
    """``df`` with the fingerprint of its text column as a further column; a null text is empty."""
    at = df.columns.index(text)
    schema = StructType([*df.schema.fields, StructField(name, LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary() if batch.column(at).type == pa.string() else pa.large_binary())
            found = pa.array([simhash(t.as_py() or b"", shingle) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=schema.names)

    return df.mapInArrow(add, schema)


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GOLAY << (bit - CHECK_BITS)
    return word


@cache
def _code() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Remainder of each low and high half of a word; for each remainder, where its patterns begin
    among all error patterns of up to RADIUS + 1 bits, the pattern to the home anchor first."""
    low = np.array([_remainder(x) for x in range(1 << 12)], np.int64)
    high = np.array([_remainder(x << 12) for x in range(1 << 11)], np.int64)
    errors = [sum(1 << b for b in c) for w in range(RADIUS + 2) for c in combinations(range(LENGTH), w)]
    errors = np.array(errors, np.int64)
    of = low[errors & 0xFFF] ^ high[errors >> 12]
    order = np.argsort(of, kind="stable")
    starts = np.searchsorted(of[order], np.arange((1 << CHECK_BITS) + 1))
    return low, high, errors[order], starts


def anchors(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into block, anchor, whether it is the home) for all anchors within RADIUS + 1 bits."""
    low, high, errors, starts = _code()
    remainder = low[block & 0xFFF] ^ high[block >> 12]
    first, n = starts[remainder], starts[remainder + 1] - starts[remainder]
    which = np.repeat(np.arange(len(block)), n)
    step = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    return which, block[which] ^ errors[first[which] + step], step == 0


def _replicated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        fp = batch["fp"].to_numpy()
        for k, (bit, length) in enumerate(BLOCKS):
            block = (fp.view(np.uint64) >> np.uint64(bit) & np.uint64((1 << length) - 1)).astype(np.int64)
            which, anchor, home = anchors(block)
            yield pd.DataFrame({"anchor": anchor | k << LENGTH, "fp": fp[which], "home": home})


def _linked(homes: np.ndarray, guests: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the two sides, as a spanning forest."""
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(homes), 256):
        part = homes[at : at + 256]
        differing = np.bitwise_count((part[:, None] ^ guests[None, :]).view(np.uint64))
        i, j = np.nonzero(differing <= max_bits)
        other = part[i] != guests[j]
        a, b = spanning_edges(np.concatenate([a, part[i[other]]]), np.concatenate([b, guests[j[other]]]))
    return a, b


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): edges that connect just what links within ``max_bits`` connect.

    ``fingerprints`` has the distinct values in column ``fp``. An anchor with many rows is dealt
    over a grid of cells, each with a bounded number of homes and guests.
    """
    if not 0 <= max_bits <= 5:
        raise ValueError("three blocks with a threshold of one bit hold for up to five differing bits")
    rows = fingerprints.select("fp").mapInPandas(_replicated, "anchor LONG, fp LONG, home BOOLEAN")
    rows = written(rows, "anchors")
    # one row for each anchor of the code, so the table has at most len(BLOCKS) * 4096 rows
    sizes = rows.groupBy("anchor").agg(
        F.ceil(F.count_if("home") / HOMES).cast("int").alias("rows_h"),
        F.ceil(F.count("*") / GUESTS).cast("int").alias("rows_g"),
    )
    cells = F.greatest(F.lit(1), F.ceil(F.count("*") / CELL_ROWS))
    n = max(rows.select(cells.cast("int")).first()[0], rows.sparkSession.sparkContext.defaultParallelism * 4)
    rows = rows.join(F.broadcast(written(sizes.where("rows_h > 0"), "anchor-sizes")), "anchor")
    own = lambda c: F.pmod(F.xxhash64("fp"), F.col(c))
    every = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c).cast("long") - 1)
    homes = rows.where("home").select("anchor", "fp", "home", own("rows_h").alias("i"), F.explode(every("rows_g")).alias("j"))
    guests = rows.select(
        "anchor", "fp", F.lit(False).alias("home"), F.explode(every("rows_h")).alias("i"), own("rows_g").alias("j")
    )
    cell = F.pmod(F.xxhash64("anchor", "i", "j"), F.lit(n)).alias("cell")
    dealt = homes.union(guests).select(cell, F.xxhash64("anchor", "i", "j").alias("at"), "fp", "home")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["at", "home"], kind="stable")
        at, fp, home = rows["at"].to_numpy(), rows["fp"].to_numpy(), rows["home"].to_numpy()
        cuts = np.concatenate([[0], np.nonzero(np.diff(at))[0] + 1, [len(at)]])
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            first_home = end - int(home[start:end].sum())
            x, y = _linked(fp[first_home:end], fp[start:first_home], max_bits)
            a.append(x)
            b.append(y)
        a, b = spanning_edges(np.concatenate(a), np.concatenate(b))
        return pd.DataFrame({"a": a, "b": b})

    return dealt.groupBy("cell").applyInPandas(compare, "a LONG, b LONG")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, simhash, group, component_id) and further columns for each row of ``docs``.

    ``docs`` has doc_id and simhash. A group is what links of up to ``max_bits`` differing bits
    connect, and component_id its smallest doc_id. Null ids are passed over when the smallest is
    taken; a group of null ids only has a null component. Repeated rows and equal fingerprints meet
    in one value before anything is compared.
    """
    values = written(docs.groupBy(F.col("simhash").alias("fp")).agg(F.min("doc_id").alias("least")), "fingerprints")
    found = components(links(values, max_bits))
    group = F.coalesce("component", "fp").alias("group")
    grouped = written(values.join(found, values.fp == found.id, "left").select("fp", "least", group), "groups")
    least = written(grouped.groupBy("group").agg(F.min("least").alias("component_id")), "group-ids")
    named = grouped.join(least, "group").select(F.col("fp").alias("simhash"), "group", "component_id")
    return docs.join(named, "simhash")


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``, which has doc_id and text.

    A null text is empty, and all texts without words share the fingerprint zero.
    """
    marked = written(with_fingerprint(docs.select("doc_id", "text"), shingle=shingle).drop("text"), "simhash")
    found = near_duplicates(marked, max_bits)
    fingerprint = F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", fingerprint, "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of near-duplicates, with the columns of ``docs``: the one with the
    smallest doc_id (nulls last); of several rows with that id, any one."""
    row = F.struct(*(name_of(c) for c in docs.columns)).alias("row")
    packed = docs.select(F.monotonically_increasing_id().alias("at"), name_of("text").alias("text"), row)
    marked = written(with_fingerprint(packed, shingle=shingle).drop("text"), "simhash-rows")
    found = near_duplicates(marked.select(F.col("row.doc_id").alias("doc_id"), "simhash", "at"), max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "at")).alias("first")
    kept = written(found.groupBy("group").agg(first).select("first.at"), "kept")
    # texts are shuffled once whatever the size: the kept rows are about as many as the rows
    return marked.join(kept.hint("merge"), "at", "left_semi").select("row.*")
