"""The streams: the change log with deletions and repeats, and the newest bulletin out of order."""

import datetime as dt
import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from firnspark.plans import pipeline
from firnspark.streaming import changes, winners
from tests.test_pipeline import document, keyed, land

DAY = dt.date(2020, 12, 1)


def run(spark, root, **options):
    warehouse = pipeline.Warehouse(spark, str(root / "warehouse"))
    changes.run_streamed(warehouse, "NWAC", str(root / "log"), str(root / "checkpoint"), **options)
    return warehouse


def report(spark, root):
    changes.report_landed(spark, str(root / "landing"), str(root / "log"))


def test_changes_deletions_and_repeats(spark, tmp_path):
    for n in range(3):
        day = DAY + dt.timedelta(days=n)
        land(tmp_path / "landing", day, [document(day, zone, 1 + n) for zone in ("Olympics", "Mt Hood")])
    report(spark, tmp_path)
    entries = spark.read.parquet(str(tmp_path / "log")).count()
    report(spark, tmp_path)
    assert spark.read.parquet(str(tmp_path / "log")).count() == entries == 3
    warehouse = run(spark, tmp_path)
    assert len(keyed(warehouse.table("targets"), "problem_type_0")) == 6

    # A file is overwritten, one is deleted; the run fails after its tables are stored and is repeated.
    land(tmp_path / "landing", DAY, [document(DAY, "Olympics", 3, 13)])
    (tmp_path / "landing" / f"{DAY + dt.timedelta(days=1)}.json").unlink()
    report(spark, tmp_path)

    def fail(number):
        raise RuntimeError(f"stopped after batch {number}")

    with pytest.raises(StreamingQueryException, match="stopped after batch 1"):
        run(spark, tmp_path, stored=fail)
    seen = []
    run(spark, tmp_path, stored=seen.append)
    assert seen == [1]
    targets = keyed(warehouse.table("targets"), "problem_type_0")
    assert targets == {("NWAC.1128", DAY): 3, **{(r, DAY + dt.timedelta(days=2)): 3 for r in ("NWAC.1128", "NWAC.1140")}}
    # Nothing new: no batch at all.
    run(spark, tmp_path, stored=seen.append)
    assert seen == [1]


def test_log_refuses_files_without_a_day(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "odd.json").write_text(json.dumps([]))
    with pytest.raises(ValueError, match="odd.json"):
        report(spark, tmp_path)


ROWS = "region_id string, forecast_date date, publish_datetime timestamp, analysis_datetime timestamp, note string"


def bulletin(day, hour, note, analysed=0, region="r"):
    at = dt.datetime(2021, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=day)
    when = None if hour is None else at + dt.timedelta(hours=hour)
    return region, at.date(), when, at + dt.timedelta(hours=analysed), note


def land_rows(spark, root, rows):
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(str(root / "in"))


def follow(spark, root, **options):
    winners.run_winners(spark, str(root / "in"), spark.createDataFrame([], ROWS).schema, str(root / "table"), str(root / "points"), **options)
    return {(r.region_id, r.forecast_date.day): r.note for r in spark.read.parquet(str(root / "table")).collect()}


def test_newest_out_of_order(spark, tmp_path):
    land_rows(spark, tmp_path, [bulletin(0, 8, "b"), bulletin(0, 5, "a"), bulletin(1, None, "no time"), bulletin(40, 1, "later month")])
    assert follow(spark, tmp_path) == {("r", 1): "b", ("r", 2): "no time", ("r", 10): "later month"}
    # Late and older, newer, equal but analysed later, and the first with a time.
    land_rows(spark, tmp_path, [bulletin(0, 7, "late"), bulletin(1, 2, "first"), bulletin(0, 8, "checked", 3), bulletin(0, 1, "other", region="q")])
    want = {("r", 1): "checked", ("r", 2): "first", ("r", 10): "later month", ("q", 1): "other"}
    assert follow(spark, tmp_path) == want
    assert follow(spark, tmp_path) == want


def test_stored_table_decides_once_state_is_gone(spark, tmp_path):
    """Without state an older bulletin passes the stream, but not the stored table."""
    land_rows(spark, tmp_path, [bulletin(0, 8, "newest")])
    follow(spark, tmp_path, keep=dt.timedelta(milliseconds=1))
    land_rows(spark, tmp_path, [bulletin(0, 3, "older")])
    assert follow(spark, tmp_path, keep=dt.timedelta(milliseconds=1)) == {("r", 1): "newest"}
    again = spark.createDataFrame([bulletin(0, 8, "newest"), bulletin(0, 8, "newest")], ROWS)
    winners.store_newest(spark, again, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).where(F.col("note") == "newest").count() == 1


def test_streamed_query_makes_its_documents_once(spark, tmp_path, monkeypatch):
    from firnspark.plans import catalogue, pipeline, standin

    made, landed = [], []
    text = '{"type": "avalancheForecast", "areaId": "a"}'
    rows = spark.createDataFrame([(k, dt.date(2023, 11, 5), text) for k in range(4)], "k long, day date, document string")
    monkeypatch.setattr(standin, "caic_documents", lambda *_: made.append(1) or rows)
    monkeypatch.setattr(catalogue.changes, "report_landed", lambda _, path, log: landed.append(spark.read.json(path).count()))
    monkeypatch.setattr(catalogue.changes, "run_streamed", lambda *_, **options: None)
    monkeypatch.setattr(pipeline.Warehouse, "table", lambda *_: spark.range(0).selectExpr(*[f"0 AS {c}" for c in (*catalogue.tables.KEYS, *catalogue._SHOWN)]))
    assert catalogue.streamed_targets(spark, str(tmp_path)).count() == 0
    assert landed == [2, 4] and len(made) == 1
