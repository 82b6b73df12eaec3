"""Counts that are kept per partition, against counts of the whole table."""

import random

from pyspark.sql import functions as F

from tierfold.sources import null_counts, tables

SCHEMA = "k INT, v INT, t STRING, p STRING"


def test_counts_after_merges_of_any_kind(spark, tmp_path):
    path, rng = str(tmp_path / "table"), random.Random(4)
    parts = [None, "7", "a b/c:1", "a=b%", "x+y", "é"]

    def rows(keys, parts):
        made = [(k, rng.choice([None, 1]), rng.choice([None, None, "t"]), rng.choice(parts)) for k in keys]
        return spark.createDataFrame(made, SCHEMA)

    batches = [rows(range(60), parts), rows(range(10, 30), ["x+y"]), rows(range(60), ["7", None]), rows(range(60, 70), ["é"])]
    for batch in batches:
        table = tables.merge_partitioned(spark, path, batch, ["k"], "p")
        found = {r.column: (r.rows, r.nulls) for r in null_counts.null_counts(spark, path, batch, "p").collect()}
        counted = table.agg(F.count(F.lit(1)), *(F.count_if(F.col(c).isNull()) for c in "kvt")).first()
        assert found == {c: (counted[0], counted[i + 1]) for i, c in enumerate("kvt")}
        assert null_counts.renew(spark, path, batch, "p") == []
    one = rows([61], ["é"])
    tables.merge_partitioned(spark, path, one, ["k"], "p")
    assert null_counts.renew(spark, path, one, "p") == ["p=é"]


def test_counts_of_an_empty_table(spark, tmp_path):
    path, none = str(tmp_path / "table"), spark.createDataFrame([], SCHEMA)
    tables.merge_partitioned(spark, path, none, ["k"], "p")
    assert null_counts.null_counts(spark, path, none, "p").collect() == []
    some = spark.createDataFrame([(1, None, "t", "a")], SCHEMA)
    tables.merge_partitioned(spark, path, some, ["k"], "p")
    assert null_counts.null_counts(spark, path, some, "p").count() == 3
    tables.reset(spark, path)
    tables.merge_partitioned(spark, path, some, ["k"], "p")
    assert null_counts.renew(spark, path, some, "p") == ["p=a"]
