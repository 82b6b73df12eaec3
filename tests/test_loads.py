"""Loads of documents do each step once, and rows that need not travel stay where they are."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks.documents import event_documents
from tierfold.operators.dedupe import latest_per_key
from tierfold.operators.refs import with_documents
from tierfold.plans import bronze
from tierfold.plans import event_documents as E
from tierfold.sources import tables


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def event(number, *bouts):
    return json.dumps({"id": number, "date": "2024-05-01T10:00Z", "competitions": list(bouts)})


def test_a_load_reads_each_document_once(spark, tmp_path):
    bout = {"id": 3, "competitors": [{"athlete": {"$ref": "http://a"}}, {"winner": False}]}
    texts = [event(1, bout, {**bout, "id": 4}), event(2, bout), event(2, {**bout, "name": "again"}), "no JSON"]
    documents = spark.createDataFrame([(t,) for t in texts], "text STRING")
    refs = spark.createDataFrame([("http://a", '{"fullName": "A"}')], "url STRING, payload STRING")
    for name, found in (("plain", None), ("followed", refs)):
        read = spark.sparkContext.accumulator(0)

        @F.udf("string")
        def payload(text, read=read):
            read.add(1)
            return text

        run, root = bronze.Run("20250101T000000Z", date(2025, 1, 1)), bronze.Bronze(str(tmp_path / name))
        events, bouts = bronze.load_bronze(spark, root, documents.select(payload("text").alias("payload")), run, found)
        assert read.value == len(texts)
        assert [r.event_id for r in events.orderBy("event_id").collect()] == ["1", "2"]
        plain = documents.select(F.col("text").alias("payload"))
        rows = latest_per_key(bronze.valid_bouts(plain, run, found), bronze.BOUT_KEYS, ["event_date"], bronze._tiebreak())
        assert bag(bouts.select(rows.columns)) == bag(rows) and len(bag(rows)) == 3


def test_event_rows_that_hold_their_bouts(spark):
    texts = [
        event(1, {"id": 3, "date": "2020"}), '{"competitions": [{"date": "2021"}, "x"]}', '{"id": 2, "competitions": []}',
        '{"header": {"id": 4, "date": "", "competitions": [{"date": 5}, {"$ref": "http://x"}]}}', "{broken", None,
    ]
    documents = spark.createDataFrame([(t,) for t in texts], "payload STRING")
    opened = E.event_rows(documents, parts=E.BOUT_PARTS)
    assert bag(opened.drop(*E.BOUT_PARTS)) == bag(E.event_rows(documents))
    assert bag(E.read_bouts(E.opened_bouts(opened))) == bag(E.bout_rows(documents))


@pytest.mark.parametrize("share", [0.0, 0.5, 1.0])
def test_latest_of_stored_rows(spark, tmp_path, monkeypatch, share):
    """Rows of single keys are read where they are; those of others, and of no key, are ranked."""
    monkeypatch.setattr(tables, "REPEATED", share)
    k = F.col("id")
    key = F.when(k < 40, k).when(k < 50, k % 4 + 100)
    rows = spark.range(55).select(key.alias("k"), k.alias("at"), F.repeat(F.lit("x"), 9).alias("text"))
    path = str(tmp_path / "rows")
    for some, repeated in ((rows, True), (rows.where("k < 40"), False)):
        some.write.mode("overwrite").parquet(path)
        stored = spark.read.parquet(path)
        with tables.latest_stored(stored, ["k"], ["at"]) as latest:
            assert bag(latest) == bag(latest_per_key(stored, ["k"], ["at"]))
            text = latest._jdf.queryExecution().optimizedPlan().toString()
            assert "Window" not in text and ("Join" in text) == (repeated and share > 0.3)


def test_replaced_partitions_are_not_read(spark, tmp_path, monkeypatch):
    """A partition none of whose rows stays is not read, and one that loses none is not joined."""
    plans, replace = [], tables.journal.replace

    def replaced(spark, path, rows, *args, **more):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        replace(spark, path, rows, *args, **more)

    monkeypatch.setattr(tables.journal, "replace", replaced)
    path, k = str(tmp_path / "t"), F.col("id")
    rows = spark.range(30).select(k.alias("k"), (k % 3).cast("int").alias("p"), F.lit("old").alias("v"))
    tables.merge_partitioned(spark, path, rows, ["k"], "p")
    new = rows.withColumn("v", F.lit("new"))
    fresh = new.where("k < 3").withColumn("k", F.col("k") + 100)
    for batch, joined, scans in (
        (new.where("p = 1"), 0, 1),  # replaces all of a partition
        (fresh.where("p = 0"), 0, 2),  # adds to a partition
        (new.where("k < 9 OR p = 2").unionByName(fresh.where("p = 1")), 1, None),
    ):
        before = {r.k: tuple(r) for r in tables.stored(spark, path, rows, "p").select(*rows.columns).collect()}
        table = tables.merge_partitioned(spark, path, batch, ["k"], "p")
        before |= {r.k: tuple(r) for r in batch.collect()}
        assert bag(table.select(*rows.columns)) == sorted(before.values(), key=str)
        text = plans[-1]
        assert text.count("Join") == joined and scans in (None, text.count("Relation"))


def test_documents_are_built_without_lambdas(spark, tmp_path, plan):
    """A lambda over the bouts of an order is not compiled, and took most of a load's time."""
    orders = [(k, 7, "F", 1.0, None, "1-X") for k in (5, 6, 7, -1, -5, None)]
    kinds = "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP, o_orderpriority STRING"
    spark.createDataFrame(orders, kinds).write.parquet(str(tmp_path / "orders.parquet"))
    documents = event_documents(spark, str(tmp_path))
    assert "lambdafunction" not in plan(documents)
    rows = E.bout_rows(documents).groupBy("event_id").agg(F.sort_array(F.collect_list("competition_id")))
    assert {r[0]: r[1] for r in rows.collect()} == {
        "5": ["50", "51", "52"], "6": ["60"], "7": ["70", "71"], "-1": ["-10", "-11"], "-5": ["-50", "-51", "-52"],
    }


def test_pointers_are_found_without_lambdas(spark, plan):
    """Each text is parsed once for its pointers, and no filter on them parses it again below."""
    u = lambda name: {"$ref": f"http://{name}"}
    pair = [{"athlete": u("a"), **u("c")}, {"statistics": u("s")}, u("third")]
    cases = [
        ({"weightClass": u("w"), "status": u("t"), "competitors": pair}, "w t a c s"),
        ({"competitors": {**u("box"), "items": pair}, "weight": u("w")}, "box w a c s"),
        ({"items": pair, **u("self"), "athlete": u("x"), "statistics": u("y")}, "self x y a c s"),
        ({"competitors": "text", "statistics": [u("in a list")], "weight": {"$ref": ""}}, ""),
    ]
    texts = [(json.dumps(o), {f"http://{n}" for n in names.split()}) for o, names in cases] + [("{broken", set()), (None, set())]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "n INT, text STRING")
    found = E.bout_pointers(rows, "text", "urls")
    assert "lambdafunction" not in plan(found) and found.columns == ["n", "text", "urls"]
    box = {"http://box"}  # an object of competitors is taken as a list of one, and as a box
    for r in found.collect():
        assert set(filter(None, r.urls)) - box == texts[r.n][1] - box
    refs = spark.createDataFrame([("http://a", '{"fullName": "A"}')], "url STRING, payload STRING")
    held = with_documents(rows, refs, "text", ["n"], E.bout_pointers, E.HOPS)
    lines = held._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [line for line in lines if "Filter" in line and "from_json" in line]
    assert {r.n: r.held for r in held.collect()} == {n: {"http://a": '{"fullName": "A"}'} if n < 3 else None for n in range(6)}
