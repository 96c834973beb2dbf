"""From the combined table to targets and features, and the grids that address them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from firnspark.functions import calendar as cal
from firnspark.functions import codes
from firnspark.functions.aspects import (
    ASPECTS,
    COMPONENTS,
    ELEVATIONS,
    SLOTS,
    component_sql,
    flag_of_bits_sql,
    mask_of_bits_sql,
    slot_bits,
)
from firnspark.operators.lookup import lookup_join, within
from firnspark.schema import BULLETIN, FEATURES, TARGETS, conform, slot_columns, stamp
from firnspark.session import materialise

KEYS = ["region_id", "forecast_date"]


# --- latest publication -----------------------------------------------------------


def latest_publication(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The row published last for every key.

    Equal publication times are settled by the analysis time and then by a hash of the
    remaining columns, so any rows still equal are copies of each other.  Spark limits
    every map partition to one row per key before the shuffle (WindowGroupLimit), which
    keeps a key that owns much of the table cheap.
    """
    keys = keys or KEYS
    order = [F.col("publish_datetime").desc()]
    if "analysis_datetime" in df.columns:
        order.append(F.col("analysis_datetime").desc())
    order.append(F.xxhash64(*sorted(df.columns)).desc())
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def same_day_in_season(combined: DataFrame) -> DataFrame:
    """Bulletins for the day they were issued; the season is that of the source row."""
    return combined.where((F.col("forecast_days_out") == 0) & (F.col("avalanche_season") != cal.OFF_SEASON))


def pack_slots(df: DataFrame) -> DataFrame:
    """Replace the 72 flag columns by one integer per slot, to keep shuffled rows narrow."""
    flags = [name for slot in SLOTS for name in slot_columns(slot)]
    return df.withColumns({f"_bits_{slot}": slot_bits(slot) for slot in SLOTS}).drop(*flags)


def component_columns() -> list[str]:
    """The 27 aspect components from the packed slots, as named SQL expressions."""
    return [
        f"{component_sql(component, mask_of_bits_sql(slot, elevation))} AS aspect_{component}_{elevation}_{slot}"
        for slot in SLOTS
        for elevation in ELEVATIONS
        for component in COMPONENTS
    ]


def flag_columns() -> list[str]:
    return [
        f"{flag_of_bits_sql(slot, aspect, elevation)} AS {aspect}_{elevation}_{slot}"
        for slot in SLOTS
        for elevation in ELEVATIONS
        for aspect in ASPECTS
    ]


def with_aspect_components(df: DataFrame) -> DataFrame:
    """Add the 27 components to any frame that has the 72 flag columns."""
    packed = df.withColumns({f"_bits_{slot}": slot_bits(slot) for slot in SLOTS})
    return packed.selectExpr(*[f"`{name}`" for name in df.columns], *component_columns())


def requested_only(df: DataFrame, requested: DataFrame | None) -> DataFrame:
    """Keep the exact (forecast_date, region_id) pairs of a request.

    The request is joined without shuffling ``df`` by its keys, so a pair that owns much
    of the table is still reduced map-side by whatever follows.
    """
    if requested is None:
        return df
    return within(df, materialise(requested.select(*KEYS).distinct()), KEYS)


MODEL_SOURCE = ["publish_datetime", "analysis_datetime", *KEYS] + [f"problem_type_{k}" for k in SLOTS]


def daily_winners(combined: DataFrame, requested: DataFrame | None = None, wide: bool = False) -> DataFrame:
    """The valid same-day bulletin of every region and day, with packed flags.

    Targets and features are two readings of these rows.  Unless ``wide``, only what
    targets and models need goes through the shuffle: keys, types and three integers.
    """
    flags = [name for slot in SLOTS for name in slot_columns(slot)]
    columns = BULLETIN.names if wide else MODEL_SOURCE + flags
    packed = pack_slots(same_day_in_season(combined).select(*columns))
    return latest_publication(requested_only(packed, requested))


def targets_of(winners: DataFrame, run_id: str = "run", created: Column | None = None) -> DataFrame:
    """Winners with their aspect components as targets: 35 columns."""
    rows = winners.selectExpr("*", *component_columns())
    key = codes.run_key(F.col("forecast_date"), F.col("region_id"))
    return conform(stamp(rows, run_id, key, created), TARGETS)


def next_day(df: DataFrame) -> DataFrame:
    return df.withColumn("forecast_date", F.date_add("forecast_date", 1))


def features_of(winners: DataFrame, run_id: str = "run", created: Column | None = None) -> DataFrame:
    """Wide winners under the next day's date: 142 columns.

    The shift is one calendar day, so a day without a bulletin gives no feature for the
    day after.  Season, day number and distribution date stay those of the source day.
    """
    rows = next_day(winners).selectExpr("*", *component_columns(), *flag_columns())
    key = codes.run_key(F.col("forecast_date"), F.col("region_id"))
    return conform(stamp(rows, run_id, key, created), FEATURES)


def model_inputs_of(winners: DataFrame) -> DataFrame:
    """The feature columns models use, from narrow winners."""
    types = [f"problem_type_{slot}" for slot in SLOTS]
    return next_day(winners).selectExpr(*KEYS, *types, *component_columns())


def build_targets(
    combined: DataFrame, requested: DataFrame | None = None, run_id: str = "run", created: Column | None = None
) -> DataFrame:
    return targets_of(daily_winners(combined, requested), run_id, created)


def build_features(
    combined: DataFrame, requested: DataFrame | None = None, run_id: str = "run", created: Column | None = None
) -> DataFrame:
    """Features of the requested days, from the bulletins of the days before them."""
    if requested is not None:
        requested = requested.select("region_id", F.date_sub("forecast_date", 1).alias("forecast_date"))
    return features_of(daily_winners(combined, requested, wide=True), run_id, created)


# --- grids -------------------------------------------------------------------------


def region_dimension(df: DataFrame) -> DataFrame:
    return df.select("region_id").distinct()


def daily_grid(regions: DataFrame, first: dt.date | Column, last: dt.date | Column) -> DataFrame:
    """Every day of the interval for every region."""
    limits = [F.lit(day) if isinstance(day, dt.date) else day for day in (first, last)]
    return regions.select(F.explode(cal.days_between(*limits)).alias("forecast_date"), "region_id")


def season_years(first: dt.date, last: dt.date) -> tuple[int, int]:
    """Start years of the first and last season between two days; summer days count
    for the season that follows them."""

    def start(day: dt.date) -> int:
        return day.year if day.month >= cal.SEASON_END_MONTH else day.year - 1

    return start(first), start(last)


def season_grid(regions: DataFrame, years: tuple[int, int]) -> DataFrame:
    """Every season for every region, seasons as labels and start years."""
    first, last = years
    exploded = regions.select("region_id", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("season_year"))
    return exploded.withColumn("avalanche_season", cal.season_label(F.col("season_year")))


def season_list(df: DataFrame, day: str = "forecast_date") -> DataFrame:
    """Distinct seasons of the days in a frame, in order."""
    label = cal.season(F.col(day), use_upcoming=True).alias("avalanche_season")
    return df.select(label).distinct().orderBy("avalanche_season")


def day_range(df: DataFrame, day: str = "forecast_date") -> tuple[dt.date, dt.date]:
    """First and last day of a frame: one row, needed to lay out a grid."""
    row = df.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    return row["first"], row["last"]


def missing_partitions(grid: DataFrame, stored: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Requested partitions that hold no rows yet."""
    keys = keys or KEYS
    return grid.join(stored.select(*keys).distinct(), keys, "left_anti")


def partition_values(requested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct days and the distinct regions of a list of partition keys."""
    return requested.select("forecast_date").distinct(), requested.select("region_id").distinct()


def regions_of_centers(centers: DataFrame, regions: DataFrame) -> DataFrame:
    """All regions whose id starts with a centre and a dot.

    The prefix test becomes an equi-join: a region offers each of its dotted prefixes.
    """
    parts = F.split("region_id", r"\.")
    prefixes = F.when(
        F.size(parts) > 1,
        F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), ".")),
    )
    offered = regions.withColumn("forecast_center", F.explode(prefixes))
    few = materialise(centers.distinct())
    return lookup_join(offered, few, ["forecast_center"], "inner", 64).select("forecast_center", "region_id")


# --- partition scans ---------------------------------------------------------------


def scan_partitions(
    df: DataFrame, requested: DataFrame, keys: list[str], columns: list[str] | None = None, rectangle: bool = False
) -> DataFrame:
    """Columns of the requested partitions.

    Exact keys by default.  ``rectangle=True`` takes every combination of the requested
    values of each key.  No request gives an empty frame with the table's columns.
    """
    if rectangle:
        kept = df
        for key in keys:
            values = materialise(requested.select(key).distinct())
            kept = lookup_join(kept, values, [key], "left_semi", 64)
    else:
        kept = lookup_join(df, materialise(requested.select(*keys).distinct()), keys, "left_semi", 96)
    return kept.select(*(columns or df.columns))
