"""Marts of one refresh that readers get together.

Every refresh writes its marts as tables of a new version, which no view shows yet. When all of them
stand, a plan is written beside the database and the views are turned to the new version one by one;
whoever finds the plan, the next refresh or a reader that comes through :func:`read_mart`, finishes
what was cut short. The version before stays for queries that are still running on it; older ones,
and versions that never came to a plan, are dropped.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tierfold.sources import journal, storage, tables


def _home(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def _plan(spark: SparkSession, database: str) -> str:
    return f"{_home(spark, database)}/_publication.json"


def _state(spark: SparkSession, database: str) -> str:
    return f"{_home(spark, database)}/_published.json"


def table_of(database: str, mart: str, version: int) -> str:
    return f"{database}.mv_{mart}_{version:06d}"


def _tables(spark: SparkSession, database: str) -> dict[str, int]:
    """Tables of any version by name."""
    found = ((t.name, re.fullmatch(r"mv_.*_(\d{6,})", t.name)) for t in spark.catalog.listTables(database))
    return {name: int(m[1]) for name, m in found if m}


def published_version(spark: SparkSession, database: str) -> int:
    """The version that the views show, 0 before the first one."""
    state = _state(spark, database)
    return json.loads(storage.read_text(spark, state))["version"] if storage.exists(spark, state) else 0


def next_version(spark: SparkSession, database: str) -> int:
    """A version that no table has, after a publication that was cut short is finished."""
    finish(spark, database)
    return max([*_tables(spark, database).values(), published_version(spark, database)]) + 1


def publish(
    spark: SparkSession, database: str, marts: Sequence[str], version: int, step: journal.Step = journal._nothing
) -> dict[str, DataFrame]:
    """Turn the views ``v_*`` and ``mv_*`` of these marts to a version whose tables all stand."""
    step("plan")
    plan = {"version": version, "previous": published_version(spark, database), "marts": list(marts)}
    _write(spark, _plan(spark, database), plan)
    _turn(spark, database, step)
    return {mart: spark.table(f"{database}.v_{mart}") for mart in marts}


def finish(spark: SparkSession, database: str) -> bool:
    """Finish the publication that was planned for this database, if there is one."""
    if not storage.exists(spark, _plan(spark, database)):
        return False
    _turn(spark, database, journal._nothing)
    return True


def read_mart(spark: SparkSession, database: str, mart: str) -> DataFrame:
    """A published mart."""
    finish(spark, database)
    return spark.table(f"{database}.v_{mart}")


def _turn(spark: SparkSession, database: str, step: journal.Step) -> None:
    plan = json.loads(storage.read_text(spark, _plan(spark, database)))
    for mart in plan["marts"]:
        step("turn")
        for view in (f"{database}.v_{mart}", f"{database}.mv_{mart}"):
            if spark.catalog.tableExists(view) and spark.catalog.getTable(view).tableType != "VIEW":
                spark.sql(f"DROP TABLE {view}")
            tables.publish_view(spark, view, table_of(database, mart, plan["version"]))
    step("drop")
    for name, version in _tables(spark, database).items():
        if version not in (plan["version"], plan["previous"]):
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    _write(spark, _state(spark, database), {"version": plan["version"]})
    step("forget")
    storage.remove(spark, _plan(spark, database))


def _write(spark: SparkSession, path: str, content: dict) -> None:
    """A small file that is there whole or not at all."""
    storage.write_text(spark, f"{path}.new", json.dumps(content))
    storage.move(spark, f"{path}.new", path)
