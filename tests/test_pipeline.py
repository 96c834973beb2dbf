"""Landed files to forecasts through the stored tables, in batch and by stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from firnspark.functions import codes
from firnspark.plans import pipeline
from firnspark.sources import registry as R
from firnspark.streaming import incremental

DAYS = [dt.date(2020, 11, 1) + dt.timedelta(days=n) for n in range(12)]
DAYS += [dt.date(2021, 11, 1) + dt.timedelta(days=n) for n in range(12)]
DAYS += [dt.date(2022, 11, 1) + dt.timedelta(days=n) for n in range(4)]


def document(day, zone, kind, hour=12):
    return {
        "product_type": "forecast",
        "published_time": f"{day}T20:00:00+00:00",
        "updated_at": f"{day}T{hour}:00:00+00:00",
        "bottom_line": "x",
        "danger": [{"valid_day": "current", "upper": 1, "middle": 1, "lower": 1}],
        "forecast_avalanche_problems": [
            {"rank": 1, "avalanche_problem_id": kind, "likelihood": "likely", "size": [1, 2], "location": ["north upper", "northeast upper"]}
        ],
        "forecast_zone": [{"id": 1, "name": zone, "zone_id": "z"}],
    }


def land(folder, day, documents):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{day}.json").write_text(json.dumps(documents))


def run(spark, root, **options):
    warehouse = pipeline.Warehouse(spark, str(root / "warehouse"))
    incremental.run_incremental(warehouse, "NWAC", str(root / "landing"), str(root / "progress"), files_per_batch=20, **options)
    return warehouse


def keyed(df, column):
    return {(r.region_id, r.forecast_date): r[column] for r in df.collect()}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    for n, day in enumerate(DAYS):
        land(root / "landing", day, [document(day, zone, 1 + (n + i) % 3) for i, zone in enumerate(("Olympics", "Mt Hood"))])
    return root


def test_stream_then_train_then_forecast(spark, root):
    warehouse = run(spark, root)
    targets = keyed(warehouse.table("targets"), "problem_type_0")
    assert len(targets) == 2 * len(DAYS)
    features = keyed(warehouse.table("features"), "problem_type_0")
    first = ("NWAC.1128", DAYS[0])
    assert features["NWAC.1128", DAYS[0] + dt.timedelta(days=1)] == targets[first]
    assert first not in features

    # A second run without new files changes nothing.
    run(spark, root)
    assert keyed(warehouse.table("targets"), "problem_type_0") == targets

    # Landing a day again replaces its rows, here with one region less.
    late = dt.date(2022, 11, 10)
    land(root / "landing", late, [document(late, zone, 2) for zone in ("Olympics", "Mt Hood")])
    run(spark, root)
    assert len(keyed(warehouse.table("targets"), "problem_type_0")) == 2 * len(DAYS) + 2
    # The same file, overwritten.
    land(root / "landing", late, [document(late, "Olympics", 3, 13)])
    run(spark, root)
    targets = keyed(warehouse.table("targets"), "problem_type_0")
    assert targets["NWAC.1128", late] == 3 and ("NWAC.1140", late) not in targets
    features = keyed(warehouse.table("features"), "problem_type_0")
    after = late + dt.timedelta(days=1)
    assert features["NWAC.1128", after] == 3 and ("NWAC.1140", after) not in features

    warehouse.train((2020, 2022), "first", created=F.lit("2024-01-01").cast("timestamp"))
    models = warehouse.registry.models()
    assert models.count() == 30 * 2 and {r.version for r in models.collect()} == {1}
    assert models.where("metrics['R2'] IS NOT NULL AND metrics['MAE'] IS NOT NULL").count() == 27 * 2
    warehouse.train((2020, 2022), "second")
    deployed = warehouse.registry.deployed()
    assert deployed.count() == 30 * 2 and {r.version for r in deployed.collect()} == {2}

    request = spark.createDataFrame(
        [("NWAC.1128", DAYS[-2]), ("NWAC.1140", DAYS[-2]), ("NWAC.1128", dt.date(2022, 12, 24))],
        "region_id string, forecast_date date",
    )
    for _ in range(2):
        warehouse.forecast(request, "run")
    forecasts = warehouse.table("forecasts")
    assert forecasts.count() == 2 * 30
    with pytest.raises(LookupError):
        warehouse.table("unscored")
    # The first season has features but no model to score them with.
    early = spark.createDataFrame([("NWAC.1128", DAYS[3])], "region_id string, forecast_date date")
    with pytest.raises(LookupError, match="NWAC.1128"):
        warehouse.forecast(early, "run", strict=True)
    warehouse.forecast(early, "run")
    assert [(r.region_id, r.forecast_date) for r in warehouse.table("unscored").collect()] == [("NWAC.1128", DAYS[3])]
    assert forecasts.count() == 2 * 30
    assert {r.run_id for r in spark.read.parquet(warehouse.path("evaluation/confusion")).collect()} == {"first", "second"}
    assert spark.read.parquet(warehouse.path("evaluation/lines")).count() > 0

    # Models of one region and season only.
    one = spark.createDataFrame([("NWAC.1128", 2022)], "region_id string, model_year int")
    warehouse.train((2020, 2022), "third", groups=one)
    again = warehouse.registry.deployed().where("version = 3")
    assert {(r.region_id, r.model_year) for r in again.collect()} == {("NWAC.1128", 2022)} and again.count() == 30

    # A refresh of a day reads the landed folders that hold it, and a season's models theirs.
    day = spark.createDataFrame([("NWAC.1128", late)], "region_id string, forecast_date date")
    plan = warehouse.landed_for(day)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan and "landed_date" in plan.split("PartitionFilters")[1][:200]
    plan = warehouse.registry.load_majority()._jdf.queryExecution().executedPlan().toString()
    assert "model_year" in plan.split("PartitionFilters")[1][:200]
    row = forecasts.where("model_name = 'problem_type_0' AND region_id = 'NWAC.1128'").first()
    # Types cycle 1, 2, 3, so yesterday's type tells today's.
    yesterday = targets["NWAC.1128", DAYS[-3]]
    assert row.forecast == yesterday % 3 + 1
    assert (row.analysis_date, row.avalanche_season, row.release) == (DAYS[-3], "2022/2023", "v000")
    assert row.mlflow_model_uri == "models/problem_type_0.2022-2023.NWAC.1128/versions/2"


def test_file_without_a_day(spark, tmp_path):
    day = dt.date(2020, 11, 5)
    land(tmp_path / "landing", f"{day}-late", [document(day, "Olympics", 2)])
    land(tmp_path / "landing", day, [document(day, "Olympics", 1)])
    with pytest.raises(ValueError, match="no landed day"):
        run(spark, tmp_path)
    warehouse = run(spark, tmp_path, unplaced="quarantine")
    assert warehouse.table("combined").count() == 1
    assert [r.path.rpartition("/")[2] for r in warehouse.table("unplaced").collect()] == [f"{day}-late.json"]
    assert run(spark, tmp_path).table("unplaced").count() == 1


def test_bad_documents_are_kept_apart(spark, tmp_path):
    day = dt.date(2020, 11, 5)
    doubtful = document(day, "Mt Hood", 2)
    doubtful["forecast_avalanche_problems"][0]["likelihood"] = "doubtful"
    untyped = document(day, "Mt Hood", 2) | {"product_type": None}
    land(tmp_path / "landing", day, [document(day, "Olympics", 1), doubtful, untyped])
    (tmp_path / "landing" / "2020-11-06.json").write_text("[{ not json")
    with pytest.raises(Exception, match="unknown likelihood|unreadable"):
        run(spark, tmp_path)
    warehouse = run(spark, tmp_path, mode="quarantine")
    assert [r.region_id for r in warehouse.table("combined").collect()] == ["NWAC.1128"]
    assert warehouse.table("targets").count() == 1
    refused = {(str(r.landed_date), r.region_id, *r.problems) for r in warehouse.table("quarantine").collect()}
    unreadable = "unreadable document or no product type"
    assert refused == {
        (str(day), "NWAC.1140", "unknown likelihood"), (str(day), None, unreadable), ("2020-11-06", None, unreadable),
    }
    # A corrected file takes its refused rows away.
    land(tmp_path / "landing", day, [document(day, "Olympics", 1), document(day, "Mt Hood", 2)])
    warehouse = run(spark, tmp_path, mode="quarantine")
    assert warehouse.table("combined").count() == 2 and warehouse.table("quarantine").count() == 1


def test_versions_and_aliases(spark):
    new = spark.createDataFrame([("a", "v000"), ("b", "v001")], "model_id string, release string")
    first = R.next_versions(new, None)
    second = R.next_versions(new.where("model_id = 'a'"), first)
    both = first.unionByName(second)
    latest = {(r.model_id, r.version) for r in R.latest_versions(both).collect()}
    assert latest == {("a", 2), ("b", 1)}
    other = new.where("model_id = 'a'").withColumn("release", F.lit("v001"))
    both = both.unionByName(R.next_versions(other, both))
    latest = {(r.model_id, r.release, r.version) for r in R.latest_versions(both).collect()}
    assert latest == {("a", "v000", 2), ("a", "v001", 3), ("b", "v001", 1)}


def test_deployments(spark):
    assert {r.model_name: r.release for r in R.deployments(spark).collect()} == codes.DEPLOYMENTS


def test_missing_registry_is_an_error(spark, tmp_path):
    with pytest.raises(LookupError):
        R.Registry(spark, str(tmp_path / "none")).deployed()


def test_documents_are_scanned_once_and_refusals_have_a_limit(spark, tmp_path, monkeypatch):
    """Every step after the first reads columns, not JSON; too many refusals stop before anything is stored."""
    from firnspark.sources.bulletins import scan_documents

    land(tmp_path / "landing", DAYS[0], [document(DAYS[0], "Olympics", 1), {"product_type": None}, {"product_type": None}])
    documents = scan_documents(spark, "NWAC", str(tmp_path / "landing"))
    reads, write = [], pipeline.materialise

    def watched(df, label="stage"):
        reads.append("json" in df._jdf.queryExecution().executedPlan().toString().lower())
        return write(df, label)

    monkeypatch.setattr(pipeline, "materialise", watched)
    rows, refused = pipeline.checked_rows(documents, "NWAC", mode="quarantine", refusal_limit=2)
    assert (rows.count(), refused.count()) == (1, 2)
    assert reads[0] and not any("FileScan json" in df._jdf.queryExecution().executedPlan().toString() for df in (rows, refused))
    with pytest.raises(pipeline.TooManyRefused, match="2 of 3"):
        pipeline.checked_rows(documents, "NWAC", mode="quarantine", refusal_limit=1)


@pytest.mark.parametrize("mode, stored", [("fail", 0), ("lenient", 1)])
def test_parsed_documents_are_stored_only_to_refuse_some(spark, monkeypatch, mode, stored):
    from firnspark.sources import bulletins

    texts = spark.createDataFrame([(DAYS[0], json.dumps(document(DAYS[0], "Olympics", 2)))], "landed_date date, document string")
    labels, store = [], pipeline.materialise
    monkeypatch.setattr(pipeline, "materialise", lambda frame, *label: labels.append(label) or store(frame, *label))
    rows, refused = pipeline.checked_rows(bulletins.parse_documents(texts, "NWAC", keep=("landed_date",)), "NWAC", mode=mode)
    assert labels.count(("parsed",)) == stored
    assert rows.count() == 1 and refused.count() == 0 and "problems" in refused.columns


def test_overwritten_arrays_are_read_by_ranges(spark, tmp_path, monkeypatch):
    from firnspark.plans import catalogue, standin
    from firnspark.sources import bulletins

    found = []
    text = '{"type": "avalancheForecast", "areaId": "a"}'
    made = spark.createDataFrame([(k, dt.date(2023, 11, 5), text) for k in range(4)], "k long, day date, document string")
    monkeypatch.setattr(standin, "caic_documents", lambda *_: made)

    def run_incremental(warehouse, center, landing, progress, split_bytes=None, **_):
        found.append((split_bytes > 0, bulletins.scan_documents(spark, center, landing, split_bytes=split_bytes).count()))

    monkeypatch.setattr(catalogue.incremental, "run_incremental", run_incremental)
    monkeypatch.setattr(pipeline.Warehouse, "table", lambda *_: spark.range(0).selectExpr(*[f"0 AS {c}" for c in (*catalogue.tables.KEYS, *catalogue._SHOWN)]))
    assert catalogue.incremental_overwrite(spark, str(tmp_path)).count() == 0
    assert found == [(True, 2), (True, 4)]
