import datetime as dt

from pyspark.sql import functions as F

from firnspark.operators import lookup, tables
from firnspark.plans import standin
from firnspark.schema import COMBINED, conform


def bulletin(spark, *rows):
    """Conformed combined rows from (region, day, published, days out, type, n_alp) tuples."""
    df = spark.createDataFrame(
        rows, "region_id string, day string, published string, forecast_days_out long, problem_type_0 long, n_alp_0 long"
    )
    filled = df.selectExpr(
        "*",
        "cast(day AS date) AS forecast_date",
        "cast(published AS timestamp) AS publish_datetime",
        "cast(published AS timestamp) AS analysis_datetime",
        "cast(day AS date) AS distribution_date",
    )
    from firnspark.functions import calendar as cal

    return conform(filled.withColumn("avalanche_season", cal.season(F.col("forecast_date"))), COMBINED)


def test_latest_publication_and_lag(spark):
    rows = bulletin(
        spark,
        ("R.1", "2024-01-01", "2024-01-01 08:00:00", 0, 1, 1),
        ("R.1", "2024-01-01", "2024-01-01 09:00:00", 0, 2, 0),
        ("R.1", "2024-01-01", "2024-01-01 10:00:00", 1, 3, 0),
        ("R.1", "2024-01-03", "2024-01-03 08:00:00", 0, 4, 1),
        ("R.1", "2024-05-31", "2024-05-31 08:00:00", 0, 5, 1),
        ("R.1", "2024-06-01", "2024-06-01 08:00:00", 0, 6, 1),
        ("R.1", "2024-08-31", "2024-08-31 08:00:00", 0, 7, 1),
    )
    targets = {r.forecast_date: r for r in tables.build_targets(rows).collect()}
    assert {d: r.problem_type_0 for d, r in targets.items()} == {
        dt.date(2024, 1, 1): 2,
        dt.date(2024, 1, 3): 4,
        dt.date(2024, 5, 31): 5,
    }
    assert targets[dt.date(2024, 1, 3)].aspect_range_alp_0 == 0.125
    assert targets[dt.date(2024, 1, 1)].run_key == "2024-01-01|R.1"
    features = {r.forecast_date: r for r in tables.build_features(rows).collect()}
    # The gap on January 2 stays a gap; June 1 has a feature row with its source's season.
    assert {d: r.problem_type_0 for d, r in features.items()} == {
        dt.date(2024, 1, 2): 2,
        dt.date(2024, 1, 4): 4,
        dt.date(2024, 6, 1): 5,
    }
    assert features[dt.date(2024, 6, 1)].avalanche_season == "2023/2024"
    assert features[dt.date(2024, 1, 4)].distribution_date == dt.date(2024, 1, 3)
    assert features[dt.date(2024, 1, 4)].n_alp_0 == 1


def test_equal_publication_times_have_one_winner(spark):
    twice = [("R.1", "2024-01-01", "2024-01-01 08:00:00", 0, kind, 0) for kind in (1, 2, 3)]
    first = tables.build_targets(bulletin(spark, *twice)).collect()
    second = tables.build_targets(bulletin(spark, *reversed(twice)).repartition(3)).collect()
    assert len(first) == 1 and first[0].problem_type_0 == second[0].problem_type_0


def test_requests_are_exact_pairs(spark):
    rows = bulletin(
        spark,
        *[(r, f"2024-01-0{d}", f"2024-01-0{d} 08:00:00", 0, d, 0) for r in ("R.1", "R.2") for d in (1, 2)],
    )
    request = spark.createDataFrame(
        [("R.1", dt.date(2024, 1, 1)), ("R.2", dt.date(2024, 1, 2))], "region_id string, forecast_date date"
    )
    keys = {(r.region_id, r.forecast_date.day) for r in tables.build_targets(rows, request).collect()}
    assert keys == {("R.1", 1), ("R.2", 2)}
    assert tables.scan_partitions(rows, request, tables.KEYS).count() == 2
    assert tables.scan_partitions(rows, request, tables.KEYS, rectangle=True).count() == 4
    nothing = tables.scan_partitions(rows, request.limit(0), tables.KEYS, ["region_id"])
    assert nothing.columns == ["region_id"] and nothing.count() == 0
    lagged = tables.build_features(rows, request).collect()
    assert {(r.region_id, r.forecast_date.day) for r in lagged} == {("R.2", 2)}


def test_center_prefix_is_literal(spark):
    regions = spark.createDataFrame([("A.1",), ("A.B.2",), ("AB.3",), ("A",)], "region_id string")
    centers = spark.createDataFrame([("A",), ("A.B",)], "forecast_center string")
    found = {tuple(r) for r in tables.regions_of_centers(centers, regions).collect()}
    assert found == {("A", "A.1"), ("A", "A.B.2"), ("A.B", "A.B.2")}


def test_shuffle_is_limited_to_one_row_per_key_and_task(spark):
    """The window limits rows before the exchange, and only narrow columns cross it."""
    sf = "/root/testdata/sf0.001"
    plan = tables.build_targets(standin.combined(spark, sf))._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(region_id")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]


def test_lookup_join_paths_agree(spark):
    """A hot key: the shuffled way gives what the broadcast way gives."""
    large = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 0, id % 50) AS k")
    small = spark.range(40).selectExpr("id AS k", "id * 10 AS v")
    for how in ("inner", "left", "left_semi", "left_anti"):
        direct = lookup.lookup_join(large, small, ["k"], how)
        shuffled = lookup.lookup_join(large, small, ["k"], how, row_bytes=64, limit=64)
        assert sorted(map(str, direct.collect())) == sorted(map(str, shuffled.collect()))
    assert lookup.fits_broadcast(small, 64, 64 * 40) and not lookup.fits_broadcast(small, 64, 64 * 39)
