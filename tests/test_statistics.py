import numpy as np
import pytest
from pyspark.sql import functions as F

from firnspark.operators import statistics, training
from firnspark.plans import catalogue, pipeline, standin
from firnspark.session import materialise

SF = "/root/testdata/sf0.001"
ROWS = "region_id string, season_year int, slot int, " + ", ".join(f"{n} double" for n in statistics.INPUTS + statistics.OUTPUTS)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_expanding_sums_are_a_range_frame(spark):
    stats = spark.createDataFrame([("A", 2000, 1), ("A", 2003, 10), ("B", 2002, 5), ("C", 2005, 7)], "r string, season_year int, n long")
    summed = training.expanding_sums(stats, ["r"], ["n"], (2001, 2006))
    assert sorted(map(tuple, summed.collect())) == [
        ("A", 2002, 1), ("A", 2003, 1), ("A", 2004, 1), ("A", 2005, 11), ("A", 2006, 11),
        ("B", 2004, 5), ("B", 2005, 5), ("B", 2006, 5),
    ]
    assert training.expanding_sums(stats.limit(0), ["r"], ["n"], (2001, 2006)).count() == 0


def test_fits_sum_by_a_window_and_copy_no_statistics(spark, monkeypatch):
    frame = catalogue.frame_of(spark, SF)
    monkeypatch.setattr(training, "fan_out_training", None)
    for fitted in (
        training.fit_majority(training.class_counts(frame), (1992, 1998)),
        training.fit_linear(training.moments(training.design_rows(frame)), (1992, 1998)),
    ):
        assert "Window" in plan_of(fitted)


def test_values_far_from_zero_keep_their_rank(spark):
    """Sums of raw squares would lose the variation of values around ten million."""
    rng = np.random.default_rng(3)
    rows = []
    for season in (2000, 2001, 2002):
        x = 1e7 + season + rng.normal(size=(60, 10))
        y = np.outer(x @ np.arange(10) - 4.5e8, np.ones(9))
        rows += [("R", season, 0, *map(float, a), *map(float, b)) for a, b in zip(x, y)]
    per_season = statistics.centred_moments(materialise(spark.createDataFrame(rows, ROWS)))
    fitted = {row.model_year: row for row in statistics.fit_linear_stored(per_season, (2002, 2004)).collect()}
    assert {year: row.n for year, row in fitted.items()} == {2002: 60, 2003: 120, 2004: 180}
    for row in fitted.values():
        assert row["rank"] == 10
        np.testing.assert_allclose(np.array(row.weights)[:, 1:], np.tile(np.arange(10.0), (9, 1)), atol=1e-5)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    warehouse = pipeline.Warehouse(spark, f"file://{tmp_path_factory.mktemp('warehouse')}", pipeline.MONTH)
    rows = materialise(standin.combined(spark, SF).withColumn("landed_date", F.trunc("distribution_date", "month")))
    warehouse.store_combined(rows, rows.select(*pipeline.COMBINED_FOLDERS).distinct())
    warehouse.backfill(catalogue.grid(rows.select("region_id", "forecast_date")), created=standin.created())
    return warehouse


def fullest_season(warehouse, seasons):
    return warehouse.season_frame(seasons).groupBy("season_year").count().orderBy(F.desc("count"), "season_year").first()[0]


def test_stored_training_equals_full_training(spark, warehouse):
    """Also after one season changed and was reduced again, alone."""
    years = catalogue.model_years(spark, SF)
    seasons = list(range(years[0] - 1, years[1] + 1))
    late = fullest_season(warehouse, seasons[:-2])
    warehouse.refresh_statistics(seasons)
    gone = materialise(warehouse.season_frame([late]).select("region_id", "forecast_date").limit(3))
    assert gone.count() == 3
    warehouse.store_daily("targets", warehouse.table("targets").limit(0).drop("folder_date"), gone)
    before = warehouse.stored_models(years)
    warehouse.refresh_statistics([late])
    after = warehouse.stored_models(years)
    full = pipeline.train_models(training.training_frame([warehouse.table("features")], warehouse.table("targets")), years)
    assert before.majority.exceptAll(full.majority).count() > 0
    assert after.majority.exceptAll(full.majority).count() == 0 and full.majority.exceptAll(after.majority).count() == 0

    def by_group(linear):
        return {(r.region_id, r.model_year, r.slot): (r.n, r["rank"], np.array(r.weights)) for r in linear.collect()}

    found, wanted = by_group(after.linear), by_group(full.linear)
    assert found.keys() == wanted.keys()
    for key, (n, rank, weights) in wanted.items():
        assert found[key][:2] == (n, rank)
        np.testing.assert_allclose(found[key][2], weights, atol=1e-6)
    warehouse.train((late + 2, late + 2), run_id="stored", stored=True)
    assert warehouse.registry.models().where("metrics IS NOT NULL").count() > 0


def test_one_season_is_read_from_its_folders(warehouse):
    season = fullest_season(warehouse, list(range(1990, 2003)))
    frame = warehouse.season_frame([season])
    assert "folder_date" in plan_of(frame).split("PartitionFilters: ")[1].split("]")[0]
    assert tuple(frame.agg(F.min("season_year"), F.max("season_year")).first()) == (season, season)


def test_nothing_stored(spark, tmp_path):
    with pytest.raises(LookupError):
        statistics.SeasonStatistics(spark, str(tmp_path / "none")).moments()
