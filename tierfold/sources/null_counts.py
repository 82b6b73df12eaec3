"""Row and null counts of a partitioned table, kept beside it.

Counts are kept per partition with the names of the files that were counted, whose data never
changes. A partition whose files are others now, because a merge rewrote it, is counted anew; the
counts of all others are added up as they are. Whoever asks gets the counts of the files that are
there, whether or not somebody renewed them before.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierfold.sources import journal, storage, tables

COUNTS_SCHEMA = "folder STRING, files STRING, rows BIGINT, nulls MAP<STRING, BIGINT>"


def _kept(path: str) -> str:
    return f"{path.rstrip('/')}.counts"


def _partitions(spark: SparkSession, path: str) -> dict[str, str]:
    """Partition folders with a digest of their files' names."""
    names = defaultdict(list)
    for file in storage.data_files(spark, path):
        folder, _, name = file.rpartition("/")
        names[folder].append(name)
    return {folder: hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest() for folder, files in names.items()}


def renew(spark: SparkSession, path: str, like: DataFrame, partition: str) -> list[str]:
    """Count the partitions whose files have changed since they were counted; returns their folders."""
    journal.recover(spark, path)
    now, kept = _partitions(spark, path), _kept(path)
    journal.recover(spark, kept)
    before = spark.read.schema(COUNTS_SCHEMA).parquet(kept) if storage.exists(spark, kept) else None
    held = {r.folder: r for r in before.collect()} if before is not None else {}  # one row a partition
    changed = sorted(f for f, files in now.items() if f not in held or held[f].files != files)
    if before is not None and not changed and held.keys() == now.keys():
        return []
    rows = [tuple(r) for f, r in held.items() if f in now and f not in changed]
    if changed:
        table = tables.stored(spark, path, like, partition)
        columns = [c for c in table.columns if c != partition]
        some = spark.read.schema(table.schema).option("basePath", path).parquet(*(f"{path}/{f}" for f in changed))
        file = F.col("_metadata.file_path")
        folder = F.regexp_extract(F.regexp_replace("file", r"/[^/]*$", ""), r"[^/]*$", 0)
        nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)]
        per_file = some.groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias("rows"), *nulls)  # names are taken apart once a file
        counted = per_file.groupBy(F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))).alias("folder")).agg(
            *(F.sum(c).alias(c) for c in ["rows", *(f"n{i}" for i in range(len(columns)))])
        )
        found = {r.folder: (r.rows, {c: r[f"n{i}"] for i, c in enumerate(columns)}) for r in counted.collect()}
        rows += [(f, now[f], *found.get(f, (0, dict.fromkeys(columns, 0)))) for f in changed]
    journal.replace(spark, kept, spark.createDataFrame(rows, COUNTS_SCHEMA).coalesce(1))
    return changed


def null_counts(spark: SparkSession, path: str, like: DataFrame, partition: str) -> DataFrame:
    """(column, rows, nulls) of the whole table, the partition column left out. Reads the table's
    rows only where :func:`renew` was not called after a merge."""
    renew(spark, path, like, partition)
    kept = spark.read.schema(COUNTS_SCHEMA).parquet(_kept(path))
    long = kept.select("rows", F.explode("nulls").alias("column", "nulls"))
    return long.groupBy("column").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"))
