"""The damage that read_with_fallback does to a table."""

from checks.merge_queries import _damaged
from tierfold.sources import landing


def test_a_few_bytes_of_the_smallest_file_are_damaged(spark, tmp_path):
    path = tmp_path / "table"
    rows = spark.range(20_000).selectExpr("uuid() AS name", "id", "CASE WHEN id < 5000 THEN 1 ELSE 2 END AS part")
    rows.repartition(1).write.partitionBy("part").parquet(str(path))
    files = sorted(path.rglob("part-*.parquet"), key=lambda f: f.stat().st_size)
    before = [f.read_bytes() for f in files]
    _damaged(spark, str(path))
    after = [f.read_bytes() for f in files]
    assert len(files) == 2 and after[1] == before[1] and len(after[0]) == len(before[0])
    assert 0 < sum(a != b for a, b in zip(after[0], before[0], strict=True)) <= 64
    stored = lambda: spark.read.schema("name STRING, id BIGINT, part INT").parquet(str(path))
    rebuilt = landing.read_or_rebuild(stored, lambda: spark.createDataFrame([(7,)], "id BIGINT"))
    assert [r.id for r in rebuilt.collect()] == [7]
