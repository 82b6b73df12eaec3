"""Replacing parts of a parquet folder so that a replacement that is cut short can be finished.

A folder of files has no transactions. The new files are written beside the table first, then a
plan that names, for every part of the table that changes, the files it is to hold. Only when the
plan is there, written under another name and renamed, does the table change: files move in, files
that the plan does not name go, and the journal is removed. Each of these steps can be taken again,
so whoever comes next, a reader or a writer, finishes a plan that it finds; a journal without a plan
has changed nothing, and the next writer removes it.

There may be one writer at a time. Readers that do not come through :func:`recover` can see a part
that is being replaced.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from tierfold.sources import storage

#: Called with the name of each step before it is taken; tests stop a replacement there.
Step = Callable[[str], None]
STEPS = ("write", "plan", "move", "clean", "forget")


def _nothing(step: str) -> None:
    pass


def _journal(path: str) -> str:
    return f"{path.rstrip('/')}.journal"


def _plan(path: str) -> str:
    return f"{_journal(path)}/plan.json"


def recover(spark: SparkSession, path: str) -> bool:
    """Finish the replacement that was planned for this table, if there is one."""
    if not storage.exists(spark, _plan(path)):
        return False
    _carry_out(spark, path, _nothing)
    return True


def forget(spark: SparkSession, path: str) -> None:
    storage.remove(spark, _journal(path))


def replace(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    partition: str | None = None,
    folders: Iterable[str] = ("",),
    step: Step = _nothing,
    form: str = "parquet",
) -> None:
    """Make ``rows`` the contents of some parts of a table: of all of it, or of the partition
    folders ``folders``. Rows of other partitions replace those, too; a folder without rows goes.
    ``rows`` may read the table."""
    if not recover(spark, path):
        forget(spark, path)
    step("write")
    new = f"{_journal(path)}/rows"
    writer = rows.write if partition is None else rows.write.partitionBy(partition)
    writer.format(form).save(new)
    step("plan")
    plan: dict[str, list[str]] = {folder: [] for folder in folders}
    for file in storage.data_files(spark, new):
        folder, _, name = file.rpartition("/")
        plan.setdefault(folder, []).append(name)
    storage.write_text(spark, f"{_plan(path)}.new", json.dumps(plan))
    storage.rename(spark, f"{_plan(path)}.new", _plan(path))
    _carry_out(spark, path, step)


def _carry_out(spark: SparkSession, path: str, step: Step) -> None:
    plan: dict[str, list[str]] = json.loads(storage.read_text(spark, _plan(path)))
    new = f"{_journal(path)}/rows"
    storage.make_folder(spark, path)
    for folder, names in plan.items():
        part = f"{path}/{folder}".rstrip("/")
        if names:
            storage.make_folder(spark, part)
        for name in names:
            step("move")
            storage.move(spark, f"{new}/{folder}/{name}", f"{part}/{name}")
        step("clean")
        if names or not folder:
            for other in set(storage.data_files(spark, part, deep=False)) - set(names):
                storage.remove(spark, f"{part}/{other}")
        else:
            storage.remove(spark, part)
    step("forget")
    forget(spark, path)
    spark.catalog.refreshByPath(path)
