"""Partitioned tables, marts, views, state rows and table inspection."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager, nullcontext
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from tierfold.operators.dedupe import latest_per_key
from tierfold.operators.upsert import ALWAYS, align, check_unique, met_rows, upsert
from tierfold.sources import journal, storage

# Columns of the run log and of the watermark state.
RUN_LOG_SCHEMA = (
    "run_id STRING, started_at TIMESTAMP, finished_at TIMESTAMP, run_mode STRING, "
    "years_back INT, overlap_days INT, events_count BIGINT, fights_count BIGINT, "
    "errors BIGINT, status STRING"
)
WATERMARK_SCHEMA = "last_event_date DATE, updated_at TIMESTAMP"

#: A merge gathers rows by partition, at the price of a shuffle, if its files would have fewer rows.
ROWS_A_FILE = 100_000

#: The share of rows whose keys come twice, above which all rows of a load are gathered by key.
REPEATED = 0.1

#: Folder names of the generations of a state, before their number.
GENERATION = "generation-"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def write_partitioned(df: DataFrame, path: str, partition: str, mode: str = "overwrite") -> None:
    """Write by partition value, gathering each value's rows first.

    ``rebalance`` keeps the number of files per value small and still splits a value that holds
    much of the table over several tasks.
    """
    (
        df.hint("rebalance", F.col(partition))
        .write.option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .mode(mode)
        .parquet(path)
    )


def stored(
    spark: SparkSession, path: str, like: DataFrame, partition: str | None = None
) -> DataFrame:
    """A parquet folder with the columns of its files and the partition column as declared.

    The type of ``partition`` is taken from ``like``: guessed from the folder names, the text
    ``007`` would come back as a number. A folder without files, after an empty load, has the
    columns of ``like``. A merge that was cut short is finished first.
    """
    journal.recover(spark, path)
    declared = [f for f in like.schema if f.name == partition]
    try:
        files = spark.read.option("recursiveFileLookup", "true").parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        files = StructType([f for f in like.schema if f.name != partition])
    return spark.read.schema(StructType([*files, *declared])).parquet(path)


def merge_partitioned(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition: str,
    when: str = ALWAYS,
    order: Sequence[str] = (),
    step: journal.Step = journal._nothing,
    prepared: bool = False,
) -> DataFrame:
    """Upsert into a partitioned parquet folder, rewriting only the partitions it touches.

    Touched are the partitions the batch goes to and those its keys are in now, so a row that
    moves also leaves its old partition. They are replaced through a journal: a merge that is cut
    short has either changed nothing or is finished by the next reader or merge, and running the
    same batch again gives the same table. The batch is staged, so it is computed once; a key that
    it holds twice raises. A ``prepared`` batch comes from :func:`latest_stored`, which has done both.
    Only keys and versions meet the target to find what is touched, and rows are gathered by partition
    only where files would be small otherwise. Of a partition that is replaced as a whole, no row is
    read, and where none is replaced, none is joined. Partition values are handled one by one: the
    column must have few, such as years or days.
    """

    def ready(batch: DataFrame) -> AbstractContextManager[DataFrame]:
        return nullcontext(batch) if prepared else storage.staged(batch, "batch")

    journal.recover(spark, path)
    if not storage.exists(spark, path):
        with ready(source) as batch:
            if not prepared:
                check_unique(batch, keys)
            small = _small_files(spark, batch.count(), batch.select(partition).distinct().collect())
            replace_partitions(spark, path, batch, partition, step=step, gather=small)
        return stored(spark, path, source, partition)
    target = stored(spark, path, source, partition)
    with ready(align(source, target)) as batch:
        if not prepared:
            check_unique(batch, keys)
        found = met_rows(batch, target, keys, order, when, partition)
        with storage.staged(found, "applied") as applied:
            old = f"_old_{partition}"
            arriving = {r[partition]: r["count"] for r in batch.groupBy(partition).count().collect()}
            moves = applied.groupBy("_known", old).count().collect()
            if not all(m["_known"] for m in moves):
                refused = applied.where("NOT _known").select(*dict.fromkeys([*keys, partition])).distinct()
                for r in refused.groupBy(partition).count().collect():
                    arriving[r[partition]] -= r["count"]
            touched = {v for v, rows in arriving.items() if rows} | {m[old] for m in moves if m["_known"]}
            if touched:
                listed, known = _any_of(partition, touched), {m["_known"] for m in moves}
                held = {r[partition]: r["count"] for r in target.where(listed).groupBy(partition).count().collect()}
                small = _small_files(spark, sum(held.values()) + sum(arriving.values()), touched)
                left = {m[old]: m["count"] for m in moves if m["_known"]}
                taken = batch.where(listed)
                if False in known:
                    taken = taken.join(applied.where("NOT _known").select(*keys), list(keys), "left_anti")
                parts = [taken]
                if same := held.keys() - left.keys():
                    parts.insert(0, target.where(_any_of(partition, same)))
                if fewer := {v for v, rows in left.items() if rows < held[v]}:
                    kept, gone = target.where(_any_of(partition, fewer)), applied.where("_known").select(*keys)
                    parts.insert(0, kept.join(gone, list(keys), "left_anti"))
                rows = reduce(DataFrame.unionByName, (p.select(*target.columns) for p in parts))
                replace_partitions(spark, path, rows, partition, touched, step, gather=small)
    return stored(spark, path, source, partition)


@contextmanager
def latest_stored(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column], tiebreak: Sequence[str | Column] = ()
) -> Iterator[DataFrame]:
    """:func:`latest_per_key` for rows that are stored; the result is stored, too, until the block ends.

    Keys are counted by a hash. Where few come twice, only rows of such a hash travel: the other rows
    are read where they are.
    """
    hashed = rows.withColumn("_hash", F.xxhash64(*keys))
    many = hashed.groupBy("_hash").count().where("count > 1")
    with storage.staged(many, "repeated") as repeated:
        twice = repeated.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
        if twice > REPEATED * rows.count():
            with storage.staged(latest_per_key(rows, keys, order, tiebreak), "batch") as batch:
                yield batch
        elif twice:
            again = hashed.join(repeated.select("_hash"), ["_hash"], "left_semi").select(*rows.columns)
            with storage.staged(latest_per_key(again, keys, order, tiebreak), "latest") as latest:
                once = hashed.join(repeated.select("_hash"), ["_hash"], "left_anti").select(*rows.columns)
                yield once.unionByName(latest)
        else:
            yield rows


def _any_of(partition: str, values: Iterable) -> Column:
    listed = F.col(partition).isin([v for v in values if v is not None])
    return listed | F.col(partition).isNull() if None in values else listed


def _small_files(spark: SparkSession, rows: int, values: Collection) -> bool:
    """Whether files would be small if a task of each core wrote one to each of these partitions."""
    return rows < ROWS_A_FILE * len(values) * spark.sparkContext.defaultParallelism


def replace_partitions(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    partition: str,
    values: Iterable = (),
    step: journal.Step = journal._nothing,
    form: str = "parquet",
    gather: bool = True,
) -> None:
    """Make ``rows`` the contents of the partitions they belong to and of those listed in
    ``values``: one of these without rows goes. What is cut short is finished by the next reader.
    Without ``gather`` every task writes a file to each partition it has rows for."""
    gathered = rows.hint("rebalance", F.col(partition)) if gather else rows
    folders = _folders(spark, partition, values, rows.schema[partition].dataType)
    journal.replace(spark, path, gathered, partition, folders, step, form)


def _folders(spark: SparkSession, partition: str, values: Iterable, kind: DataType) -> list[str]:
    """Folder names of partition values, as Spark writes them."""
    rows = spark.createDataFrame([(v,) for v in values], StructType([StructField("v", kind)]))
    named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    shown = rows.select(F.col("v").cast("string")).collect()
    return [named.getPartitionPathString(partition, r[0]) for r in shown]


def merge_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    when: str = ALWAYS,
    order: Sequence[str] = (),
    step: journal.Step = journal._nothing,
) -> DataFrame:
    """Upsert into an unpartitioned parquet folder, all of which is replaced through a journal.

    The batch is staged; a key that it holds twice raises.
    """
    journal.recover(spark, path)
    with storage.staged(source, "batch") as batch:
        check_unique(batch, keys)
        merged = batch
        if storage.exists(spark, path):
            merged = upsert(stored(spark, path, source), batch, keys, when, order)
        journal.replace(spark, path, merged, step=step)
    return stored(spark, path, source)


def reset(spark: SparkSession, *paths: str) -> None:
    """Backfill reset: forget tables and watermark so that the next load starts afresh."""
    for path in paths:
        journal.forget(spark, path)
        storage.remove(spark, path)
        storage.remove(spark, f"{path}.counts")


def materialize_mart(df: DataFrame, table: str) -> DataFrame:
    """Replace a mart with this result, columns included."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)
    df.sparkSession.catalog.refreshTable(table)
    return df.sparkSession.table(table)


def publish_view(spark: SparkSession, view: str, table: str) -> DataFrame:
    """Persistent view over a mart."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table}")
    return spark.table(view)


def _generations(spark: SparkSession, path: str) -> list[str]:
    """Complete generations of a state folder, oldest first: those Spark's writer has finished."""
    named = [f for f in storage.subfolders(spark, path) if f.startswith(GENERATION)]
    return [f"{path}/{f}" for f in named if storage.exists(spark, f"{path}/{f}/_SUCCESS")]


def save_watermark(mark: DataFrame, path: str) -> None:
    """Add the mark to the state folder as its next generation; an empty mark adds none.

    The last complete generation counts, so a write that is cut short leaves the mark before it.
    The one before the last is kept, older ones go.
    """
    row = mark.first()
    if row is None:
        return
    spark = mark.sparkSession
    state = spark.createDataFrame([(row["last_event_date"], datetime.now())], WATERMARK_SCHEMA)
    taken = [int(f.removeprefix(GENERATION)) for f in storage.subfolders(spark, path) if f.startswith(GENERATION)]
    following = f"{path}/{GENERATION}{max(taken, default=0) + 1:012d}"
    state.coalesce(1).write.parquet(following)
    for older in _generations(spark, path)[:-2]:
        storage.remove(spark, older)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """The saved watermark, or an empty table of the same shape."""
    complete = _generations(spark, path)
    if complete:
        return spark.read.schema(WATERMARK_SCHEMA).parquet(complete[-1])
    return spark.createDataFrame([], WATERMARK_SCHEMA)


def append_run_log(metrics: DataFrame, path: str) -> None:
    """Add one run's row to the run log."""
    metrics.coalesce(1).write.mode("append").parquet(path)


def partitions_profile(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """Rows, files and bytes per partition, from the file metadata of the scan."""
    per_file = (
        spark.read.parquet(path)
        .groupBy(partition, F.col("_metadata.file_path").alias("file"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.max("_metadata.file_size").alias("bytes"),
        )
    )
    return per_file.groupBy(partition).agg(
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("files"),
        F.sum("bytes").alias("bytes"),
    )
