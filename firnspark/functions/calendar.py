"""Season calendar and timestamp expressions.

A season runs from September 1 (included) to June 1 (excluded) and is written
``start/end``, such as ``2020/2021``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
OFF_SEASON = "OFF_SEASON"
SEASON_FIRST_MONTH = 9
SEASON_END_MONTH = 6
# Seconds, with an optional fraction of one to six digits; the Z is literal text.
BULLETIN_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]'Z'"


def season_label(start_year: Column) -> Column:
    return F.concat_ws("/", start_year.cast("string"), (start_year + 1).cast("string"))


def season_start_year(day: Column) -> Column:
    """Year in which the September on or before ``day`` falls."""
    return F.year(day) - F.when(F.month(day) < SEASON_FIRST_MONTH, 1).otherwise(0)


def in_season(day: Column) -> Column:
    return (F.month(day) >= SEASON_FIRST_MONTH) | (F.month(day) < SEASON_END_MONTH)


def season(day: Column, use_upcoming: bool = False) -> Column:
    """Season of ``day``; summer days give OFF_SEASON or, on request, the next season."""
    summer = season_label(F.year(day)) if use_upcoming else F.lit(OFF_SEASON)
    return F.when(in_season(day), season_label(season_start_year(day))).otherwise(summer)


def season_first_day(start_year: Column) -> Column:
    return F.make_date(start_year.cast("int"), F.lit(SEASON_FIRST_MONTH), F.lit(1))


def season_day_number(day: Column) -> Column:
    """Zero-based day of the season, -1 in summer."""
    return (
        F.when(in_season(day), F.datediff(day, season_first_day(season_start_year(day))))
        .otherwise(-1)
        .cast("long")
    )


def _start(label: Column) -> Column:
    return F.split(label, "/")[0].cast("int")


def season_bounds(label: Column, inclusive: str = "left") -> tuple[Column, Column]:
    """First and last day of a season; ``inclusive`` says which of the two limits
    (September 1, June 1) belongs to the interval."""
    side = inclusive.lower()
    if side not in ("left", "right", "both"):
        raise ValueError("inclusive must be left, right or both")
    first = season_first_day(_start(label))
    end = F.make_date(F.split(label, "/")[1].cast("int"), F.lit(SEASON_END_MONTH), F.lit(1))
    return (
        F.date_add(first, 1) if side == "right" else first,
        F.date_sub(end, 1) if side == "left" else end,
    )


def shift_season(label: Column, years: int) -> Column:
    """The season ``years`` later (negative: earlier)."""
    parts = F.split(label, "/")
    return F.concat_ws("/", *[(parts[i].cast("int") + years).cast("string") for i in (0, 1)])


def prior_season(label: Column) -> Column:
    return shift_season(label, -1)


def next_season(label: Column) -> Column:
    return shift_season(label, 1)


def days_between(first: Column, last: Column, inclusive: bool = True) -> Column:
    """Array of days; empty when the interval is empty (``sequence`` would count down)."""
    end = last if inclusive else F.date_sub(last, 1)
    none = F.array().cast("array<date>")
    return F.when(first <= end, F.sequence(first, end)).otherwise(none)


def parse_bulletin_timestamp(text: Column) -> Column:
    """Wall-clock timestamp of a bulletin, null when the text fits no known format."""
    return F.try_to_timestamp(text, F.lit(BULLETIN_TIMESTAMP))


def local_to_utc(wall: Column, zone: str) -> Column:
    """UTC instant of a wall-clock reading.

    In the autumn hour that occurs twice the standard-time reading is meant, while
    ``to_utc_timestamp`` gives the daylight one: take the later instant if it shows
    the same wall clock.
    """
    early = F.to_utc_timestamp(wall, zone)
    late = early + F.expr("INTERVAL 1 HOUR")
    return F.when(F.from_utc_timestamp(late, zone) == wall, late).otherwise(early)


def local_date(instant: Column, zone: str) -> Column:
    return F.to_date(F.from_utc_timestamp(instant, zone))
