"""Shared helpers: words, document keys, rows carried through an operator, written tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierfold.sources import storage

#: A word: a run of anything but the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
_WRITTEN: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def name_of(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def row_of(columns: list[str]) -> Column:
    return F.struct(*(name_of(c) for c in columns))


def boxed(df: DataFrame, carry: list[str] | None = None, **columns: Column) -> DataFrame:
    """The input row, or the columns ``carry`` of it, as one struct ``row`` beside the columns an
    operator works on, so that further input columns may have any name."""
    row = row_of(df.columns if carry is None else carry).alias("row")
    return df.select(row, *(c.alias(n) for n, c in columns.items()))


def unboxed(df: DataFrame, *columns: str, replace: dict[str, str] | None = None) -> DataFrame:
    """The input columns again, followed by ``columns``; ``replace`` maps an input column to the
    one that takes its place. An input column named like an added one gives way to it."""
    replace = replace or {}
    fields = df.schema["row"].dataType.fieldNames()
    added = {c.lower() for c in columns}
    kept = [
        (F.col(replace[f]) if f in replace else F.col("row").getField(f)).alias(f)
        for f in fields
        if f.lower() not in added
    ]
    return df.select(*kept, *columns)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def text_of(column: str | Column = "text") -> Column:
    """A text column as a string without nulls."""
    column = name_of(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def document_key(doc_id: Column, text: Column) -> dict[str, Column]:
    """Two 64-bit keys that tell documents apart even if ids are null or repeat. Rows that repeat
    both id and text are one document and share every decision."""
    return {"k1": F.xxhash64(doc_id), "k2": F.xxhash64(text)}


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and readable after executors that
    computed it are lost. :func:`release` removes these tables."""
    spark = df.sparkSession
    path = storage.new_folder(spark, f"llm-{purpose}")
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def _read_by(df: DataFrame) -> list[tuple[SparkSession, str]]:
    """The written tables that ``df`` reads."""
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    return [e for e in _WRITTEN if any(f.endswith(e[1].split(":", 1)[-1]) for f in folders)]


def drop_written(*tables: DataFrame) -> None:
    """Remove the tables that these read, once nothing needs them any more."""
    for df in tables:
        for entry in _read_by(df):
            storage.remove(*entry)
            _WRITTEN.remove(entry)


def release(spark: SparkSession, keep: DataFrame | None = None) -> None:
    """Remove all tables that :func:`written` has left, but for those that ``keep`` reads; other
    results that read them end with them."""
    kept = _read_by(keep) if keep is not None else []
    for entry in list(_WRITTEN):
        if entry[0] is spark and entry not in kept:
            storage.remove(*entry)
            _WRITTEN.remove(entry)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_text(df: DataFrame, text: str, names: list[str]) -> DataFrame:
    """The columns ``names`` of the struct ``document`` with its text replaced and n_chars with it."""
    row = F.col("document")
    new = {"text": F.col(text), "n_chars": F.length(text)}
    kinds = {f.name: f.dataType for f in df.schema["document"].dataType.fields}
    return df.select(*(new[c].cast(kinds[c]).alias(c) if c in new else row.getField(c).alias(c) for c in names))
