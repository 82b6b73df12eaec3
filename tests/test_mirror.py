"""The mirror out of the landing zone, call by call."""

import pytest

from tierfold.sources import landing, storage, tables

SCHEMA = "k INT, t STRING"


def test_late_and_repeated_runs(spark, tmp_path, monkeypatch):
    folders = [str(tmp_path / name) for name in ("landing", "raw", "ledger")]

    def land(run, *rows):
        landing.write_landing(spark.createDataFrame(rows, SCHEMA).coalesce(1), folders[0], run)

    def mirror():
        return landing.mirror_landing(spark, *folders, SCHEMA, ["k"])

    def held():
        raw = landing.scan_raw_json(spark, folders[1], f"{SCHEMA}, run_id STRING, ingestion_date DATE")
        return sorted((str(r.ingestion_date)[-2:], r.k, r.t) for r in raw.collect())

    assert mirror() == 0  # nothing has landed
    land("20250101T02", (1, "b"), (2, "b"))
    land("20250102T01", (1, "c"))
    assert (mirror(), mirror()) == (2, 0)
    assert held() == [("01", 1, "b"), ("01", 2, "b"), ("02", 1, "c")]
    land("20250101T01", (1, "a"), (3, "a"))  # late: known entities keep their last document
    assert mirror() == 1 and held() == [("01", 1, "b"), ("01", 2, "b"), ("01", 3, "a"), ("02", 1, "c")]
    land("20250102T01", (1, "C"))  # a run that lands again
    assert [r.run_id for r in landing.new_files(spark, folders[0], folders[2]).collect()] == ["20250102T01"]
    land("20250103T01", (9, "z"))
    replace = tables.replace_partitions

    def cut_short(*args, **more):
        replace(*args, **more)
        raise KeyboardInterrupt

    monkeypatch.setattr(tables, "replace_partitions", cut_short)
    with pytest.raises(KeyboardInterrupt):
        mirror()
    monkeypatch.setattr(tables, "replace_partitions", replace)
    assert mirror() == 2 and mirror() == 0
    assert held()[3:] == [("02", 1, "C"), ("03", 9, "z")] and len(held()) == 5
    assert storage.subfolders(spark, folders[1]) == [f"ingestion_date=2025-01-0{d}" for d in (1, 2, 3)]
