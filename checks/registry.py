"""Queries by name, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    queries: dict[str, Query] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return printable(query(spark, sf_dir))

            self.queries[name] = run
            if sql is not None:
                self.sql[name] = sql
            return query

        return register


REGISTRY = Registry()
query = REGISTRY.add


def printable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text, so that results compare alike in every client."""

    def shown(f):
        if isinstance(f.dataType, DateType):
            return F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            return F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        return F.col(f"`{f.name}`")

    return df.select(*(shown(f) for f in df.schema))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
