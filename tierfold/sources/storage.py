"""The shared folder that intermediate tables are written to, and folder-level operations."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which every executor can reach.

    A local session without the setting gets a temporary folder of its own, until it ends; a
    cluster must name one, since a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tierfold-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.conf.set(CHECKPOINT_SETTING, root)
    return root


def new_folder(spark: SparkSession, purpose: str) -> str:
    """Path of a fresh folder below the shared root."""
    return f"{shared_root(spark)}/tierfold/{purpose}-{uuid.uuid4().hex[:12]}"


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any Hadoop file system; a missing one is fine."""
    fs, p = _path(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, path: str, new_path: str) -> None:
    fs, p = _path(spark, path)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(new_path)):
        raise OSError(f"could not rename {path} to {new_path}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.mkdirs(p)


def move(spark: SparkSession, path: str, new_path: str) -> None:
    """Rename a file, or find that this has been done."""
    fs, p = _path(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(new_path)
    if fs.exists(p):
        fs.delete(new, False)  # left by a file system that copies to rename
        if fs.rename(p, new):
            return
    if not fs.exists(new):
        raise OSError(f"could not rename {path} to {new_path}")


def data_files(spark: SparkSession, path: str, deep: bool = True) -> list[str]:
    """Paths below a folder of the files that Spark reads: none whose name starts with _ or a dot."""
    fs, folder = _path(spark, path)
    if not fs.exists(folder):
        return []
    root, files, found = fs.makeQualified(folder).toString().rstrip("/") + "/", fs.listFiles(folder, deep), []
    while files.hasNext():
        file = files.next().getPath()
        if not file.getName().startswith(("_", ".")):
            found.append(file.toString().removeprefix(root))
    return sorted(found)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is missing."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


@contextmanager
def staged(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """A result written below the shared root, so that it is computed once and outlives the
    executors that computed it; removed when the block ends."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)
