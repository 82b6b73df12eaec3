"""JSON landing zone, raw mirror and raw scans.

Documents are kept as text files with one JSON document per line, below ``run_id=`` folders in the
landing zone and ``ingestion_date=`` folders in the raw mirror.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierfold.operators.dedupe import latest_per_key
from tierfold.sources import journal, storage, tables

LOG = logging.getLogger(__name__)
DYNAMIC = {"partitionOverwriteMode": "dynamic"}


def write_landing(df: DataFrame, path: str, run_id: str) -> None:
    """One folder per run; writing the same run again replaces only that run."""
    df.withColumn("run_id", F.lit(run_id)).write.options(**DYNAMIC).partitionBy("run_id").mode(
        "overwrite"
    ).json(path)


def mirror_raw(
    df: DataFrame,
    path: str,
    day_column: str,
    keys: Sequence[str],
    order: Sequence[str],
    tiebreak: Sequence[str] = (),
) -> None:
    """Last document per day and entity; only the days present in ``df`` are replaced.

    Rows are grouped by day before the write, so a day is a handful of files and not one file per
    task; ``rebalance`` splits a day that is too large for one task.
    """
    latest = latest_per_key(df, [day_column, *keys], order, tiebreak)
    (
        latest.hint("rebalance", F.col(day_column))
        .withColumnRenamed(day_column, "ingestion_date")
        .write.options(**DYNAMIC)
        .partitionBy("ingestion_date")
        .mode("overwrite")
        .json(path)
    )


# Columns of the ledger of mirrored files.
LEDGER_SCHEMA = "file STRING, run_id STRING, bytes BIGINT, landed_at TIMESTAMP"


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, run_id, bytes, landed_at) of the files in the landing zone; none of them is opened."""
    if not storage.exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = listed.option("pathGlobFilter", "part-*").load(path)
    return files.select(
        F.col("path").alias("file"),
        F.regexp_extract("path", r"/run_id=([^/]+)/", 1).alias("run_id"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("landed_at"),
    )


def new_files(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """The landed files that the ledger does not have as they are now."""
    landed = landed_files(spark, path)
    if not storage.exists(spark, ledger):
        return landed
    mirrored = spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    return landed.join(mirrored, ["file", "bytes", "landed_at"], "left_anti").select(landed.columns)


def run_day(run_id: Column) -> Column:
    """The day of a run, whose id starts with it."""
    return F.to_date(F.substring(run_id, 1, 8), "yyyyMMdd")


def mirror_landing(
    spark: SparkSession,
    path: str,
    raw: str,
    ledger: str,
    schema: str,
    keys: Sequence[str],
    order: Sequence[str] = ("run_id",),
    tiebreak: Sequence[str] = (),
) -> int:
    """Bring what has landed since the last call into the raw mirror; returns the number of files.

    Only runs with files that the ledger does not have are read. Their documents go to the day of
    their run, where the last one per entity by ``order`` stays, be it one mirrored before or a late
    one. A run that lands again takes the place of what was mirrored of it. The
    days are replaced through a journal and the ledger is written after them, so a call that is cut
    short is made good by the next one: the same documents change nothing. The mirror keeps the
    columns of ``schema`` and ``run_id``. File names are listed by the driver, as a scan lists them.
    """
    journal.recover(spark, raw)
    found = new_files(spark, path, ledger).collect()
    if not found:
        return 0
    columns, runs = f"{schema}, run_id STRING", {f.run_id for f in found}
    read = [f"{path}/run_id={run}" for run in sorted(runs)]
    files = spark.read.schema(columns).option("basePath", path).json(read)
    with storage.staged(files.withColumn("ingestion_date", run_day(F.col("run_id"))), "landed") as documents:
        days = [r[0] for r in documents.select("ingestion_date").distinct().collect()]
        every = documents
        if storage.exists(spark, raw):
            held = scan_raw_json(spark, raw, f"{columns}, ingestion_date DATE")
            others = F.col("ingestion_date").isin(days) & ~F.col("run_id").isin(*runs)
            every = every.unionByName(held.where(others))
        latest = latest_per_key(every, ["ingestion_date", *keys], order, tiebreak)
        tables.replace_partitions(spark, raw, latest, "ingestion_date", days, form="json")
    spark.createDataFrame(found, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(ledger)
    return len(found)


def scan_raw_json(
    spark: SparkSession, path: str, schema: StructType | str, glob: str | None = None
) -> DataFrame:
    """Raw documents of all days; the schema is given, so no inference pass reads the files."""
    reader = spark.read.schema(schema).option("basePath", path)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.json(path)


def scan_raw_text(spark: SparkSession, path: str) -> DataFrame:
    """Raw documents as unparsed text, column ``payload``."""
    return spark.read.option("basePath", path).text(path).withColumnRenamed("value", "payload")


# Spark's names for tables and files that cannot be read.
UNREADABLE = (
    "TABLE_OR_VIEW_NOT_FOUND", "PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "FAILED_READ_FILE",
    "CANNOT_READ_FILE_FOOTER",
)


def read_or_rebuild(
    read: Callable[[], DataFrame], rebuild: Callable[[], DataFrame]
) -> DataFrame:
    """The first table, or the rebuilt one if the first is missing or damaged.

    Reading is lazy and a count reads file footers only, so all columns of the first table are
    hashed: a damaged page must show up here and not in the middle of a later job. Any other
    failure, such as a lost executor, is raised. The branch taken is logged.
    """
    try:
        df = read()
        df.agg(F.bit_xor(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)))).first()
        return df
    except (PySparkException, Py4JJavaError) as e:
        found = [name for name in UNREADABLE if f"[{name}" in str(e)]
        if not found:
            raise
        LOG.warning("rebuilding, as the first table cannot be read: %s", found[0])
        return rebuild()


def ids_or_fallback(ids: DataFrame, fallback: Callable[[], DataFrame]) -> DataFrame:
    """The handed-over ids, or the derived ones when none were handed over."""
    return fallback() if ids.isEmpty() else ids
