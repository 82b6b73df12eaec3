"""Written tables and rows carried through an operator."""

from pyspark.sql import functions as F

from tierfold.llm.common import boxed, document_key, drop_written, let, release, unboxed, with_text, written
from tierfold.sources import storage


def folder(df):
    return df.inputFiles()[0].rsplit("/", 1)[0]


def test_written_tables_are_kept_and_removed(spark):
    a, b, c = (written(spark.range(k), "test") for k in (1, 2, 3))
    paths = [folder(x) for x in (a, b, c)]
    assert all(storage.shared_root(spark) in p for p in paths)
    drop_written(a)
    release(spark, keep=b.withColumn("x", F.lit(1)))
    assert [storage.exists(spark, p) for p in paths] == [False, True, False]
    assert b.count() == 2
    release(spark)
    assert not storage.exists(spark, paths[1])


def test_rows_keep_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, 2, "t")], "`row` INT, `a.b` INT, SIZE STRING")
    made = boxed(df, size=F.lit(7), text=F.lit("new"))
    assert unboxed(made, "size").columns == ["row", "a.b", "size"]
    assert unboxed(made, replace={"SIZE": "text"}).first().SIZE == "new"
    assert boxed(df, ["a.b"]).select("row.*").columns == ["a.b"]


def test_text_is_replaced_with_its_length(spark):
    df = spark.sql("SELECT named_struct('text', 'abc', 'n_chars', 3L, 'x', 1) AS document, 'é' AS new")
    assert tuple(with_text(df, "new", ["text", "n_chars", "x"]).first()) == ("é", 1, 1)


def test_value_is_bound_once(spark):
    df = spark.range(3).select(let(F.array(F.rand(), F.rand()), lambda x: F.get(x, F.lit(0)) - F.get(x, F.lit(0))).alias("d"))
    assert {r.d for r in df.collect()} == {0.0}


def test_documents_without_ids_have_keys(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (1, "a"), (1, None), (None, "a")], "doc_id LONG, text STRING")
    keys = document_key(F.col("doc_id"), F.col("text"))
    found = df.select(*(c.alias(k) for k, c in keys.items()))
    assert found.distinct().count() == 4 and found.where("k1 IS NULL OR k2 IS NULL").isEmpty()
