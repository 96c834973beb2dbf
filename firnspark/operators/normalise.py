"""Nested bulletins to the wide combined table.

Arrays are taken apart with array expressions in the row they arrive in; the only
generator is the one that makes a row per forecast day (or per zone), so nothing is
shuffled before the write.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from firnspark.functions import calendar as cal
from firnspark.functions import codes
from firnspark.functions.aspects import ASPECTS, ELEVATIONS, SLOTS
from firnspark.schema import BULLETIN, conform, missing_required
from firnspark.sources.bulletins import CORRUPT

# Reporting time zones of the two centres.
CAIC_ZONE = "America/Denver"
NWAC_ZONE = "America/Los_Angeles"

ERRORS = "_errors"
UNREADABLE = "unreadable document or no product type"
PRODUCT_COLUMNS = {"CAIC": "type", "NWAC": "product_type"}

# Bit of every flag name in the packed form of a list of names.
FLAG_BITS = {f"{a}_{e}": 8 * i + j for i, e in enumerate(ELEVATIONS) for j, a in enumerate(ASPECTS)}


def flag_place(name: Column) -> Column:
    """Place of a flag name in ``FLAG_BITS`` from 1 on, 0 for any other name."""
    return codes.place_among(list(FLAG_BITS), name)


def phrase_place(phrase: Column) -> Column:
    """The same for a spelled-out phrase."""
    phrases = {short: phrase for phrase, short in codes.KNOWN_PHRASES.items()}
    known = codes.place_among([phrases[name] for name in FLAG_BITS], phrase)
    return F.when(known > 0, known).otherwise(flag_place(codes.phrase_to_flag(phrase)))


def packed_names(names: Column, place: Callable[[Column], Column]) -> Column:
    """One integer with a bit for every listed flag name, one up from ``FLAG_BITS``; null for no list.

    The lowest bit tells that some name is no flag.
    """

    def seen_with(seen: Column, name: Column) -> Column:
        return seen.bitwiseOR(F.call_function("shiftleft", F.lit(1), F.coalesce(place(name), F.lit(0))))

    return F.aggregate(names, F.lit(0), seen_with)


def unlisted_names(names: Column) -> Column:
    """The distinct names that are no flags."""
    return F.array_except(names, F.array(*[F.lit(name) for name in FLAG_BITS]))


def with_packed(
    rows: DataFrame, place: Callable[[Column], Column], spelled: Callable[[Column], Column], united: bool = False
) -> DataFrame:
    """Replace the lists of every slot by bits of its flags, bits of the names that are counted, and other names.

    ``_names_slot`` are counted; with ``united`` the flags are those of ``_flags_slot`` where this is not null.
    ``place`` finds a listed name, ``spelled`` turns a list into names as flags are written.
    """
    packed = {f"_packed_{slot}": packed_names(F.col(f"_names_{slot}"), place) for slot in SLOTS}
    if united:
        packed |= {f"_united_{slot}": packed_names(F.col(f"_flags_{slot}"), place) for slot in SLOTS}
    kept = [c for c in rows.columns if not c.startswith("_flags_")]
    rows = rows.select(*kept, *[column.alias(name) for name, column in packed.items()])
    parts = {}
    for slot in SLOTS:
        own = F.col(f"_packed_{slot}")
        flags = F.when(F.col(f"_many_{slot}"), F.col(f"_united_{slot}")).otherwise(own) if united else own
        parts[f"_bits_{slot}"] = F.shiftright(flags, 1)
        parts[f"_named_{slot}"] = F.shiftright(own, 1)
        parts[f"_other_{slot}"] = F.when(own.bitwiseAND(F.lit(1)) == 1, unlisted_names(spelled(F.col(f"_names_{slot}"))))
    kept = [c for c in rows.columns if not c.startswith(("_names_", "_packed_", "_united_", "_many_"))]
    return rows.select(*kept, *[column.alias(name) for name, column in parts.items()])


def slot_values(slot: int) -> dict[str, Column]:
    """Wide columns of the coded problem of a slot and of what ``with_packed`` made of its lists.

    The prevalence of an elevation counts the distinct names that mention it, flags or not.
    """
    values = {
        f"problem_type_{slot}": F.col(f"_kind_{slot}"),
        f"likelihood_{slot}": F.col(f"_likelihood_{slot}"),
        f"min_size_{slot}": F.col(f"_min_size_{slot}"),
        f"max_size_{slot}": F.col(f"_max_size_{slot}"),
    }
    by_elevation = {}
    for i, elevation in enumerate(ELEVATIONS):
        listed = F.bit_count(F.col(f"_named_{slot}").bitwiseAND(F.lit(255 << 8 * i)))
        other = F.expr(f"size(filter(_other_{slot}, name -> contains(name, '{elevation}')))")
        more = F.when(F.size(f"_other_{slot}") > 0, other).otherwise(0)
        by_elevation[elevation] = (listed + more).cast("long")
    values |= {f"{e}_prevalence_{slot}": count for e, count in by_elevation.items()}
    values[f"prevalence_{slot}"] = by_elevation["alp"] + by_elevation["tln"] + by_elevation["btl"]
    for name, bit in FLAG_BITS.items():
        values[f"{name}_{slot}"] = F.expr(f"cast(shiftright(_bits_{slot}, {bit}) & 1 AS bigint)")
    return values


def _season_columns(day: Column) -> dict[str, Column]:
    return {
        "forecast_date_season_day_number": cal.season_day_number(day),
        "avalanche_season": cal.season(day),
    }


def _of_product(documents: DataFrame, column: str, product: str, mode: str) -> DataFrame:
    """Documents of one product type, whatever its case; other products are dropped.

    A document without a type, or one the reader could not parse, is an error; outside the mode
    ``fail`` it is left to ``unreadable_documents``.
    """
    wanted = F.upper(column) == product
    if mode == "fail":
        stop = F.raise_error(F.lit(UNREADABLE)).cast("boolean")
        wanted = F.when(_unreadable(documents, column), stop).otherwise(wanted)
    elif CORRUPT in documents.columns:
        wanted = wanted & F.col(CORRUPT).isNull()
    return documents.where(wanted)


def _unreadable(documents: DataFrame, column: str) -> Column:
    unreadable = F.col(column).isNull()
    return unreadable | F.col(CORRUPT).isNotNull() if CORRUPT in documents.columns else unreadable


def unreadable(documents: DataFrame, center: str) -> Column:
    """Whether no normaliser can take a document."""
    return _unreadable(documents, PRODUCT_COLUMNS[center])


def unreadable_documents(documents: DataFrame, center: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Documents that no normaliser can take, as ``keep`` columns, their text and a message."""
    rest = F.to_json(F.struct(*[c for c in documents.columns if c not in (*keep, CORRUPT)]))
    text = F.coalesce(F.col(CORRUPT), rest) if CORRUPT in documents.columns else rest
    return documents.where(_unreadable(documents, PRODUCT_COLUMNS[center])).select(
        *keep, text.alias("document"), F.array(F.lit(UNREADABLE)).alias(ERRORS)
    )


def _empty(problem: Column, fields: tuple[str, ...]) -> Column:
    empty = problem[fields[0]].isNull()
    for name in fields[1:]:
        empty = empty & problem[name].isNull()
    return problem.isNull() | empty


def _number(text: Column) -> Column:
    return text.try_cast("double")


def _wrong(checks: dict[str, Column]) -> Column:
    return reduce(or_, [part.isNull() for part in checks.values()])


def _none() -> Column:
    return F.array().cast("array<string>")


def _problem_errors(problems: Column, checks: Callable[[Column], dict[str, Column]], present: Callable, wrong: Column) -> Column:
    """Messages for every non-empty problem with a part that is missing or not understood.

    They are only put together where something is ``wrong``.
    """

    def messages(problem: Column) -> Column:
        return F.array_compact(
            F.array(*[F.when(part.isNull(), F.lit(message)) for message, part in checks(problem).items()])
        )

    found = F.flatten(F.transform(F.filter(problems, present), messages))
    return F.when(wrong, F.coalesce(found, _none())).otherwise(_none())


PARTS = ("kind", "likelihood", "min_size", "max_size", "names")


def _parts(slot: int, parts: tuple[Column, ...]) -> dict[str, Column]:
    """Columns of the coded problem of a slot."""
    return {f"_{name}_{slot}": part for name, part in zip(PARTS, parts, strict=True)}


def caic_days(documents: DataFrame, mode: str = "fail", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per bulletin and forecast day.

    The number of days is that of the longer of the rating and problem lists.
    """
    ratings = F.col("dangerRatings.days")
    problems = F.col("avalancheProblems.days")
    summaries = F.col("avalancheSummary.days")
    days_out = F.greatest(F.size(ratings), F.size(problems))
    entries = F.transform(
        F.when(days_out > 0, F.sequence(F.lit(0), days_out - 1)),
        lambda day: F.struct(
            day.alias("day"),
            F.get(ratings, day).alias("danger"),
            F.get(problems, day).alias("problems"),
            F.get(summaries, day)["content"].alias("summary"),
        ),
    )
    expiry = cal.parse_bulletin_timestamp(F.col("expiryDateTime"))
    issued = cal.local_to_utc(cal.parse_bulletin_timestamp(F.col("issueDateTime")), CAIC_ZONE)
    # What is the same for all days is worked out before there is a row for each.
    return (
        _of_product(documents, PRODUCT_COLUMNS["CAIC"], "AVALANCHEFORECAST", mode)
        .select(
            *keep,
            F.col("areaId").alias("area_id"),
            F.col("title").alias("area_name"),
            F.array_join("polygons", ",").alias("polygons"),
            F.to_date(expiry).alias("distribution_date"),
            issued.alias("analysis_datetime"),
            entries.alias("entries"),
        )
        .select("*", F.inline("entries"))
        .drop("entries")
    )


def _caic_present(problem: Column) -> Column:
    return ~_empty(problem, ("type", "likelihood", "expectedSize", "aspectElevations"))


def _caic_checks(problem: Column) -> dict[str, Column]:
    return {
        "unknown problem type": codes.problem_code(problem["type"]),
        "unknown likelihood": codes.likelihood_code_ranged(problem["likelihood"]),
        "bad size": _number(problem["expectedSize"]["min"]) + _number(problem["expectedSize"]["max"]),
        "no aspect list": problem["aspectElevations"],
    }


def _caic_parts(problem: Column) -> tuple[Column, ...]:
    return (
        codes.problem_code(problem["type"]),
        codes.likelihood_code_ranged(problem["likelihood"]),
        _number(problem["expectedSize"]["min"]),
        _number(problem["expectedSize"]["max"]),
        problem["aspectElevations"],
    )


def normalise_caic(documents: DataFrame, mode: str = "fail", keep: tuple[str, ...] = ()) -> DataFrame:
    """CAIC bulletins as combined rows: one per region and forecast day."""
    days = caic_days(documents, mode, keep)
    day = F.date_add(F.col("distribution_date"), F.col("day"))
    values = {
        "region_id": codes.region_key("CAIC", F.col("area_id")),
        "forecast_center": F.lit("CAIC"),
        "publish_datetime": F.col("analysis_datetime"),
        "forecast_date": day,
        "forecast_days_out": F.col("day"),
        **_season_columns(day),
        "avalanche_summary": F.col("summary"),
    }
    for elevation in ELEVATIONS:
        values[f"danger_{elevation}"] = codes.risk_code(F.col("danger")[elevation])
    # The problems of the slots are coded as columns, compiled; only those beyond are looked at in a lambda.
    problems = {}
    for slot in SLOTS:
        problem = F.get("problems", F.lit(slot))
        present = F.coalesce(_caic_present(problem), F.lit(False))
        problems[f"_present_{slot}"] = present
        problems |= _parts(slot, tuple(F.when(present, part) for part in _caic_parts(problem)))
        values |= slot_values(slot)
    count = len(SLOTS)
    beyond = F.slice("problems", count + 1, F.size("problems") - count)
    odd = F.exists(beyond, lambda problem: _caic_present(problem) & _wrong(_caic_checks(problem)))
    wrong = F.when(F.size("problems") > count, odd)
    days = days.withColumns(problems)
    for slot in SLOTS:
        missing = reduce(or_, [F.col(f"_{part}_{slot}").isNull() for part in PARTS])
        wrong = wrong | (F.col(f"_present_{slot}") & missing)
    errors = _problem_errors(F.col("problems"), _caic_checks, _caic_present, wrong)
    dropped = ["problems", *[f"_present_{slot}" for slot in SLOTS]]
    days = with_packed(days.withColumn(ERRORS, errors).drop(*dropped), flag_place, lambda names: names)
    wrong = {
        "bad expiry time": F.col("distribution_date").isNull(),
        "bad issue time": F.col("analysis_datetime").isNull(),
    }
    return _finish(days, values, wrong, mode, keep)


def _nwac_present(problem: Column) -> Column:
    return ~_empty(problem, ("rank", "avalanche_problem_id", "likelihood", "size", "location"))


def _nwac_checks(problem: Column) -> dict[str, Column]:
    return {
        "problem without rank": problem["rank"],
        "unknown problem type": problem["avalanche_problem_id"],
        "unknown likelihood": codes.likelihood_code_spaced(problem["likelihood"]),
        "bad size": _number(F.get(problem["size"], F.lit(0))) + _number(F.get(problem["size"], F.lit(1))),
        "no aspect list": problem["location"],
    }


def _nwac_parts(problem: Column) -> tuple[Column, ...]:
    size = problem["size"]
    return (
        problem["avalanche_problem_id"],
        codes.likelihood_code_spaced(problem["likelihood"]),
        _number(F.get(size, F.lit(0))),
        _number(F.get(size, F.lit(1))),
        problem["location"],
    )


def _of_rank(slot: int) -> Callable[[Column], Column]:
    return lambda problem: _nwac_present(problem) & (problem["rank"] - 1 == slot)


def current_danger(danger: Column) -> Column:
    """First rating that is valid for the current day, null when there is none."""
    return F.get(F.filter(danger, lambda d: d["valid_day"] == "current"), F.lit(0))


def normalise_nwac(
    documents: DataFrame, mode: str = "fail", zones: str = "last", keep: tuple[str, ...] = ()
) -> DataFrame:
    """NWAC bulletins as combined rows.

    ``zones="last"`` gives one row per bulletin, named after its last zone;
    ``zones="all"`` gives one row per zone.
    """
    if zones not in ("last", "all"):
        raise ValueError("zones must be last or all")
    zone = F.explode_outer("forecast_zone") if zones == "all" else F.try_element_at("forecast_zone", F.lit(-1))
    day = cal.local_date(F.try_to_timestamp(F.col("published_time")), NWAC_ZONE)
    rows = (
        _of_product(documents, PRODUCT_COLUMNS["NWAC"], "FORECAST", mode)
        .withColumn("zone", zone)
        .withColumns(
            {
                "distribution_date": day,
                "analysis_datetime": F.try_to_timestamp(F.col("updated_at")),
                "danger_now": current_danger(F.col("danger")),
            }
        )
        .withColumn("area_id", codes.area_of_zone(F.col("zone.name"), F.col("zone.id")))
        .drop("danger", "forecast_zone")
    )
    values = {
        "region_id": codes.region_key("NWAC", F.col("area_id")),
        "forecast_center": F.lit("NWAC"),
        "publish_datetime": F.col("analysis_datetime"),
        "forecast_date": F.col("distribution_date"),
        "forecast_days_out": F.lit(0),
        **_season_columns(F.col("distribution_date")),
        "area_name": F.col("zone.name"),
        "polygons": F.col("zone.zone_id"),
        "avalanche_summary": codes.first_text(F.col("bottom_line"), F.col("hazard_discussion")),
        "danger_alp": F.col("danger_now.upper"),
        "danger_tln": F.col("danger_now.middle"),
        "danger_btl": F.col("danger_now.lower"),
    }
    listed = F.col("forecast_avalanche_problems")
    wrong = F.exists(listed, lambda problem: _nwac_present(problem) & _wrong(_nwac_checks(problem)))
    ranked = {f"_ranked_{slot}": F.filter(listed, _of_rank(slot)) for slot in SLOTS}
    rows = rows.withColumns({ERRORS: _problem_errors(listed, _nwac_checks, _nwac_present, wrong)} | ranked)
    problems = {}
    for slot in SLOTS:
        own = F.col(f"_ranked_{slot}")
        problems |= _parts(slot, _nwac_parts(F.try_element_at(own, F.lit(-1))))
        # The flags of one problem are its names.
        many = F.size(own) > 1
        problems |= {f"_many_{slot}": many, f"_flags_{slot}": F.when(many, F.flatten(F.transform(own, lambda p: p["location"])))}
        values |= slot_values(slot)
    rows = rows.withColumns(problems).drop("forecast_avalanche_problems", *ranked)
    rows = with_packed(rows, phrase_place, lambda names: F.transform(names, codes.phrase_to_flag), united=True)
    wrong = {
        "bad publish time": F.col("distribution_date").isNull(),
        "bad update time": F.col("analysis_datetime").isNull(),
        "no current danger": F.col("danger_now").isNull(),
    }
    return _finish(rows, values, wrong, mode, keep)


def _finish(
    rows: DataFrame, values: dict[str, Column], wrong: dict[str, Column], mode: str, keep: tuple[str, ...]
) -> DataFrame:
    """Project to the declared columns and apply the error policy.

    ``wrong`` says by message what is wrong with a row, besides its problems.  ``fail`` stops the job at
    the first bad row, ``quarantine`` keeps all rows with their messages for ``split_quarantine``,
    ``lenient`` only fills defaults.  Only bad rows have their messages put together.
    """
    if mode not in ("fail", "quarantine", "lenient"):
        raise ValueError("mode must be fail, quarantine or lenient")
    columns = {name: F.col(name) for name in BULLETIN.names if name in rows.columns} | values
    own = F.array_compact(F.array(*[F.when(found, F.lit(message)) for message, found in wrong.items()]))
    errors = F.when(reduce(or_, wrong.values()), F.concat(own, F.col(ERRORS))).otherwise(F.col(ERRORS))
    wide = rows.select(
        *keep,
        *[column.alias(name) for name, column in columns.items()],
        errors.alias(ERRORS),
    )
    fitted = conform(wide, BULLETIN, keep=(*keep, ERRORS))
    if mode == "lenient":
        return fitted.drop(ERRORS)
    lacking = reduce(or_, [F.col(spec.name).isNull() for spec in BULLETIN.columns if spec.required])
    missing = F.transform(missing_required(fitted, BULLETIN), lambda n: F.concat(F.lit("missing "), n))
    errors = F.when(lacking, F.concat(F.col(ERRORS), missing)).otherwise(F.col(ERRORS))
    if mode == "quarantine":
        return fitted.withColumn(ERRORS, errors)
    # The check sits in a key column: a filter would be pushed down and repeat the parsing.
    stop = F.raise_error(F.concat_ws("; ", errors)).cast("string")
    good = (F.size(ERRORS) == 0) & ~lacking
    return fitted.withColumn("region_id", F.when(good, F.col("region_id")).otherwise(stop)).drop(ERRORS)


def split_quarantine(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without messages, bad rows with them)."""
    good = checked.where(F.size(ERRORS) == 0).drop(ERRORS)
    return good, checked.where(F.size(ERRORS) > 0)


NORMALISERS = {"CAIC": normalise_caic, "NWAC": normalise_nwac}


def normalise(documents: DataFrame, center: str, mode: str = "fail", keep: tuple[str, ...] = (), **options) -> DataFrame:
    if center not in NORMALISERS:
        raise ValueError(f"unsupported forecast center {center!r}")
    return NORMALISERS[center](documents, mode=mode, keep=keep, **options)


def combine(*frames: DataFrame) -> DataFrame:
    """Rows of all centres in one table."""
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame)
    return combined


def pivot_problems(problems: DataFrame, keys: list[str], values: dict[str, str]) -> DataFrame:
    """Long (key, slot, value...) rows to one row per key with ``name_slot`` columns.

    The slots are known, so this is one aggregation without a pass to find them; a slot
    listed twice keeps its largest values.
    """
    return problems.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("slot") == slot, F.col(value))).alias(f"{name}_{slot}")
            for slot in SLOTS
            for name, value in values.items()
        ]
    )
