import datetime as dt

import pytest
import pytz
from pyspark.sql import functions as F

from firnspark.functions import calendar as cal
from firnspark.operators.tables import season_years


def one(spark, column, value, kind="string"):
    return spark.range(1).select(F.lit(value).cast(kind).alias("v")).select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "day, expected",
    [
        ("2000-12-01", "2000/2001"),
        ("2000-01-01", "1999/2000"),
        ("2000-09-01", "2000/2001"),
        ("2000-05-31", "1999/2000"),
        ("2000-06-01", "OFF_SEASON"),
        ("2000-08-31", "OFF_SEASON"),
    ],
)
def test_season(spark, day, expected):
    assert one(spark, cal.season, day, "date") == expected


def test_season_upcoming(spark):
    upcoming = lambda d: cal.season(d, use_upcoming=True)
    assert one(spark, upcoming, "2000-07-01", "date") == "2000/2001"
    assert one(spark, upcoming, "2000-05-31", "date") == "1999/2000"


@pytest.mark.parametrize("day, number", [("2000-12-01", 91), ("2000-02-01", 153), ("2000-09-01", 0), ("2000-07-01", -1)])
def test_day_number(spark, day, number):
    assert one(spark, cal.season_day_number, day, "date") == number


@pytest.mark.parametrize(
    "side, first, last",
    [("left", (9, 1), (5, 31)), ("both", (9, 1), (6, 1)), ("right", (9, 2), (6, 1))],
)
def test_season_bounds(spark, side, first, last):
    bounds = lambda s: F.struct(*cal.season_bounds(s, side))
    assert tuple(one(spark, bounds, "2000/2001")) == (dt.date(2000, *first), dt.date(2001, *last))


def test_season_bounds_rejects_unknown_side():
    with pytest.raises(ValueError):
        cal.season_bounds(None, "middle")


def test_neighbouring_seasons(spark):
    assert one(spark, cal.prior_season, "2000/2001") == "1999/2000"
    assert one(spark, cal.next_season, "1999/2000") == "2000/2001"


@pytest.mark.parametrize(
    "first, last, inclusive, count",
    [
        ("2000-01-01", "2000-01-03", True, 3),
        ("2000-01-01", "2000-01-03", False, 2),
        ("2000-01-01", "2000-01-01", True, 1),
        ("2000-01-01", "2000-01-01", False, 0),
        ("2000-01-02", "2000-01-01", True, 0),
    ],
)
def test_days_between(spark, first, last, inclusive, count):
    days = cal.days_between(F.lit(first).cast("date"), F.lit(last).cast("date"), inclusive)
    assert len(spark.range(1).select(days).first()[0]) == count


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-02T03:04:05Z", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02T03:04:05.5Z", dt.datetime(2024, 1, 2, 3, 4, 5, 500000)),
        ("2024-01-02T03:04:05.123456Z", dt.datetime(2024, 1, 2, 3, 4, 5, 123456)),
        ("2024-01-02 03:04", None),
    ],
)
def test_parse_bulletin_timestamp(spark, text, expected):
    stamp = one(spark, lambda s: F.date_format(cal.parse_bulletin_timestamp(s), "yyyy-MM-dd HH:mm:ss.SSSSSS"), text)
    assert stamp == (expected and expected.strftime("%Y-%m-%d %H:%M:%S.%f"))


def test_local_to_utc_matches_standard_time_reading(spark):
    """Every half hour of six years, both clock changes included."""
    zone = pytz.timezone("America/Denver")
    start = dt.datetime(2019, 1, 1)
    rows = (
        spark.range(6 * 365 * 48)
        .select(F.timestamp_seconds(F.lit(int(start.replace(tzinfo=dt.UTC).timestamp())) + F.col("id") * 1800).alias("wall"))
        .select(F.unix_seconds("wall").alias("w"), F.unix_seconds(cal.local_to_utc(F.col("wall"), zone.zone)).alias("u"))
        .collect()
    )
    epoch = dt.datetime(1970, 1, 1)
    wrong = [w for w, u in rows if zone.localize(epoch + dt.timedelta(seconds=w)).timestamp() != u]
    assert wrong == []


def test_season_years():
    assert season_years(dt.date(2020, 1, 1), dt.date(2024, 7, 1)) == (2019, 2024)
    assert season_years(dt.date(2020, 9, 1), dt.date(2021, 5, 31)) == (2020, 2020)
