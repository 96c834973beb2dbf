"""The registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from firnspark.functions import aspects, calendar as cal, codes
from firnspark.operators import evaluate, normalise, plugins, scoring, tables, training, trees
from firnspark.operators.statistics import SeasonStatistics, fit_linear_stored
from firnspark.plans import oracles as sql
from firnspark.plans import pipeline, standin
from firnspark.schema import ColumnSpec, conform, null_violations, table
from firnspark.session import materialise, scratch_path
from firnspark.sources import arrays, bulletins, storage
from firnspark.sources.registry import Registry, deployments, describe_models, linear_payload
from firnspark.streaming import changes, incremental, winners

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    """Dates as text and timestamps as milliseconds, so that engines agree on the types."""
    forms = {"date": "cast(`{0}` AS string) AS `{0}`", "timestamp": "unix_millis(`{0}`) AS `{0}`"}
    return df.selectExpr(*[forms.get(kind, "`{0}`").format(name) for name, kind in df.dtypes])


@query("combined_view", sql.with_steps("combined", f"SELECT {sql.bulletin_columns()} FROM combined"))
def combined_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(standin.combined(spark, sf_dir).drop("run_id", "run_key", "creation_datetime"))


RUN_KEY = "CAST({day} AS VARCHAR) || chr(124) || region_id AS run_key"
CREATED_MS = "1704067200000 AS creation_datetime"


@query(
    "target_table",
    sql.with_steps(
        "components",
        "SELECT 'run' AS run_id, " + RUN_KEY.format(day="forecast_date") + f", {CREATED_MS}, "
        "CAST(forecast_date AS VARCHAR) AS forecast_date, region_id, " + ", ".join(sql.MODEL_COLUMNS) + " FROM components",
    ),
)
def target_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(tables.build_targets(standin.combined(spark, sf_dir), created=standin.created()))


@query(
    "feature_table",
    sql.with_steps(
        "components",
        "SELECT 'run' AS run_id, " + RUN_KEY.format(day="CAST(forecast_date + 1 AS DATE)") + f", {CREATED_MS}, "
        "CAST(CAST(forecast_date + 1 AS DATE) AS VARCHAR) AS forecast_date, "
        + sql.bulletin_columns(names=[n for n in sql.BULLETIN.names if n != "forecast_date"])
        + ", "
        + ", ".join(sql.COMPONENT_COLUMNS)
        + " FROM components",
    ),
)
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(tables.build_features(standin.combined(spark, sf_dir), created=standin.created()))


# --- calendar ---------------------------------------------------------------------------


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, day): order keys spread over the year, so that every season rule is met."""
    orders = standin.read(spark, sf_dir, "orders")
    return orders.select(F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("day"))


_DAYS = "FROM (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day FROM orders)"
_SHIFTED = (
    "CASE WHEN {0} = 'OFF_SEASON' THEN NULL ELSE CAST(CAST(split_part({0}, '/', 1) AS INTEGER) + ({1}) AS VARCHAR) "
    "|| '/' || CAST(CAST(split_part({0}, '/', 2) AS INTEGER) + ({1}) AS VARCHAR) END"
)


@query(
    "season_of_order",
    f"SELECT k, season, upcoming, in_season, day_number, {_SHIFTED.format('season', -1)} AS prior, "
    f"{_SHIFTED.format('season', 1)} AS following FROM (SELECT k, {sql.season_sql('day')} AS season, "
    f"{sql.season_sql('day', True)} AS upcoming, {sql.in_season_sql('day')} AS in_season, "
    f"{sql.day_number_sql('day')} AS day_number {_DAYS})",
)
def season_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("day")
    named = order_days(spark, sf_dir).select(
        "k",
        cal.season(day).alias("season"),
        cal.season(day, use_upcoming=True).alias("upcoming"),
        cal.in_season(day).alias("in_season"),
        cal.season_day_number(day).alias("day_number"),
    )
    real = F.when(F.col("season") != cal.OFF_SEASON, F.col("season"))
    return named.select("*", cal.prior_season(real).alias("prior"), cal.next_season(real).alias("following")).withColumns(
        {name: F.when(real.isNotNull(), F.col(name)) for name in ("prior", "following")}
    )


@query(
    "season_bounds",
    "SELECT season, " + ", ".join(
        f"CAST(make_date(y, 9, 1) + {lo} AS VARCHAR) AS {side}_first, CAST(make_date(y + 1, 6, 1) - {hi} AS VARCHAR) AS {side}_last"
        for side, lo, hi in (("left_limit", 0, 1), ("right_limit", 1, 0), ("both_limits", 0, 0))
    ).replace("make_date(y, 9, 1) + 0", "make_date(y, 9, 1)").replace("make_date(y + 1, 6, 1) - 0", "make_date(y + 1, 6, 1)")
    + f" FROM (SELECT DISTINCT {sql.season_sql('day', True)} AS season, CASE WHEN month(day) >= 6 THEN year(day) "
    f"ELSE year(day) - 1 END AS y {_DAYS})",
)
def season_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    seasons = tables.season_list(order_days(spark, sf_dir), "day").withColumnRenamed("avalanche_season", "season")
    columns = {}
    for side, name in (("left", "left_limit"), ("right", "right_limit"), ("both", "both_limits")):
        first, last = cal.season_bounds(F.col("season"), side)
        columns |= {f"{name}_first": first, f"{name}_last": last}
    return plain(seasons.withColumns(columns))


@query("season_list", f"SELECT DISTINCT {sql.season_sql('day', True)} AS avalanche_season {_DAYS}")
def season_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.season_list(order_days(spark, sf_dir), "day")


@query(
    "season_counts",
    sql.with_steps(
        "combined",
        "SELECT region_id, avalanche_season, count(*) AS n FROM combined WHERE avalanche_season <> 'OFF_SEASON' GROUP BY ALL",
    ),
)
def season_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.combined(spark, sf_dir).where(F.col("avalanche_season") != cal.OFF_SEASON)
    return rows.groupBy("region_id", "avalanche_season").agg(F.count(F.lit(1)).alias("n"))


# Intervals of -2 to 4 days: the empty ones must stay empty.
@query(
    "day_ranges",
    f"""SELECT k, CAST(greatest(n + 1, 0) AS INTEGER) AS n_inclusive, CAST(greatest(n, 0) AS INTEGER) AS n_exclusive,
        CASE WHEN n >= 0 THEN CAST(day + n AS VARCHAR) END AS last_inclusive
        FROM (SELECT k, day, CAST(k % 7 - 2 AS INTEGER) AS n {_DAYS})""",
)
def day_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = order_days(spark, sf_dir).withColumn("last", F.date_add("day", (F.col("k") % 7 - 2).cast("int")))
    closed = cal.days_between(F.col("day"), F.col("last"))
    half_open = cal.days_between(F.col("day"), F.col("last"), inclusive=False)
    return plain(
        days.select(
            "k",
            F.size(closed).alias("n_inclusive"),
            F.size(half_open).alias("n_exclusive"),
            F.try_element_at(closed, F.lit(-1)).alias("last_inclusive"),
        )
    )


@query(
    "days_per_region",
    sql.with_steps(
        "combined",
        "SELECT region_id, CAST(d AS VARCHAR) AS day, count(*) AS n FROM "
        "(SELECT region_id, unnest(CASE WHEN n >= 0 THEN generate_series(forecast_date, forecast_date + n, INTERVAL 1 DAY) ELSE [] END)::DATE AS d "
        "FROM (SELECT *, CAST(danger_alp - 1 AS INTEGER) AS n FROM combined)) GROUP BY ALL",
    ),
)
def days_per_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.date_add("forecast_date", (F.col("danger_alp") - 1).cast("int"))
    rows = standin.combined(spark, sf_dir).select(
        "region_id", F.explode(cal.days_between(F.col("forecast_date"), last)).alias("day")
    )
    return plain(rows.groupBy("region_id", "day").agg(F.count(F.lit(1)).alias("n")))


@query(
    "parsed_timestamps",
    "SELECT event_id, epoch_us(CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN ts "
    "WHEN 2 THEN date_trunc('millisecond', ts) END) AS micros, "
    "CASE WHEN event_id % 4 < 3 THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS day FROM events",
)
def parsed_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with no fraction, six and three digits, and one no format accepts."""
    ts = F.col("ts").cast("timestamp")
    forms = ["yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"]
    text = F.when(F.col("event_id") % 4 == 3, F.date_format(ts, "dd/MM/yyyy HH:mm"))
    for i, form in enumerate(forms):
        text = text.when(F.col("event_id") % 4 == i, F.date_format(ts, form))
    parsed = cal.parse_bulletin_timestamp(F.col("text"))
    events = standin.read(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return events.select(
        "event_id", F.unix_micros(parsed).alias("micros"), F.to_date(parsed).cast("string").alias("day")
    )


# Half-hour readings around both clock changes of every year the orders cover.
_WALL = "(o_orderdate + to_minutes(30 * (o_orderkey % 48)))"


@query(
    "local_issue_time",
    f"SELECT o_orderkey AS k, epoch_ms(timezone('America/Denver', {_WALL}) AT TIME ZONE 'UTC') AS utc_ms FROM orders",
)
def local_issue_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    wall = standin.plus_seconds(F.col("o_orderdate").cast("timestamp"), k % 48 * 1800)
    orders = standin.read(spark, sf_dir, "orders").select(k.alias("k"), wall.alias("wall"))
    return orders.select("k", F.unix_millis(cal.local_to_utc(F.col("wall"), "America/Denver")).alias("utc_ms"))


@query(
    "local_event_day",
    "SELECT day, CAST(min(ts_day) AS VARCHAR) AS first_utc_day, count(*) AS n FROM (SELECT CAST(CAST((ts AT TIME ZONE 'UTC') "
    "AT TIME ZONE 'America/Los_Angeles' AS DATE) AS VARCHAR) AS day, CAST(ts AS DATE) AS ts_day FROM events) GROUP BY ALL",
)
def local_event_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    events = standin.read(spark, sf_dir, "events").select(
        cal.local_date(ts, "America/Los_Angeles").alias("day"), F.to_date(ts).alias("utc")
    )
    return plain(events.groupBy("day").agg(F.min("utc").alias("first_utc_day"), F.count(F.lit(1)).alias("n")))


# --- names and identifiers ------------------------------------------------------------------


def _upper_codes(table: dict[str, int], name: str, default: str = "NULL") -> str:
    return f"CAST({sql.code_sql(table, name, default)} AS BIGINT)"


_RISK = ["noForecast", "LOW", "moderate", "Considerable", "high", "EXTREME", "", "severe"]
_PROBLEM = ["dryLoose", "LOOSEDRY", "stormSlab", "windSlab", "persistentSlab", "deepPersistentSlab", "wetLoose", "wetSlab", "cornice", "glide", "noForecast", "icefall"]
_RANGED = ["unlikely", "possible_likely", "likely", "veryLikely_almostCertain", "certain", "almostCertain", "noForecast", "doubtful"]
_SPACED = ["unlikely", "possible", "likely", "very likely", "almost certain", "no forecast", "certain", "Likely"]


def named_orders(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    k = F.col("o_orderkey")
    return standin.read(spark, sf_dir, "orders").select(
        k.alias("k"),
        F.when(k % 9 != 8, standin.pick(_RISK, k % 9)).alias("risk"),
        standin.pick(_PROBLEM, k % 12).alias("problem"),
        standin.pick(_RANGED, F.floor(k / 3) % 8).alias("ranged"),
        standin.pick(_SPACED, F.floor(k / 5) % 8).alias("spaced"),
        *more,
    )


_NAMED = (
    f"FROM (SELECT o_orderkey AS k, {sql.pick_sql(_RISK, 'o_orderkey % 9')} AS risk, "
    f"{sql.pick_sql(_PROBLEM, 'o_orderkey % 12')} AS problem, {sql.pick_sql(_RANGED, '(o_orderkey // 3) % 8')} AS ranged, "
    f"{sql.pick_sql(_SPACED, '(o_orderkey // 5) % 8')} AS spaced FROM orders)"
)


@query(
    "name_codes",
    f"SELECT k, {_upper_codes(codes.RISK_CODES, 'upper(risk)', '0')} AS risk_code, "
    f"{_upper_codes(codes.PROBLEM_CODES | {'DRYLOOSE': 1}, 'upper(problem)')} AS problem_code, "
    f"{_upper_codes(codes.LIKELIHOOD_CODES | {'CERTAIN': 5}, 'upper(split_part(ranged, chr(95), 1))')} AS ranged_code, "
    f"{_upper_codes(codes.LIKELIHOOD_CODES, 'upper(replace(spaced, chr(32), chr(0)))').replace('chr(0)', repr(''))} AS spaced_code {_NAMED}",
)
def name_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named_orders(spark, sf_dir).select(
        "k",
        codes.risk_code(F.col("risk")).alias("risk_code"),
        codes.problem_code(F.col("problem")).alias("problem_code"),
        codes.likelihood_code_ranged(F.col("ranged")).alias("ranged_code"),
        codes.likelihood_code_spaced(F.col("spaced")).alias("spaced_code"),
    )


_EXTRA_WORDS = [*standin.ASPECT_WORDS, "flat"]
_EXTRA_LEVELS = [*standin.ELEVATION_WORDS, "valley"]


@query(
    "phrase_flags",
    f"SELECT k, word || '_' || level AS flag FROM (SELECT o_orderkey AS k, "
    f"{sql.pick_sql([*aspects.ASPECTS, 'flat'], 'o_orderkey % 9')} AS word, "
    f"{sql.pick_sql([*aspects.ELEVATIONS, 'valley'], '(o_orderkey // 9) % 4')} AS level FROM orders)",
)
def phrase_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    phrase = F.concat_ws(" ", standin.pick(_EXTRA_WORDS, k % 9), standin.pick(_EXTRA_LEVELS, F.floor(k / 9) % 4))
    orders = standin.read(spark, sf_dir, "orders").select(k.alias("k"), phrase.alias("phrase"))
    return orders.select("k", codes.phrase_to_flag(F.col("phrase")).alias("flag"))


@query(
    "zone_regions",
    f"""SELECT k, area_id, 'NWAC.' || area_id AS region_id, CAST(day AS VARCHAR) || chr(124) || 'NWAC.' || area_id AS run_key,
        starts_with('NWAC.' || area_id, 'NWAC.11') AS mapped FROM (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day,
        CAST(coalesce({sql.code_sql(codes.NWAC_AREA_IDS, sql.pick_sql(standin.ZONE_NAMES, 'o_orderkey % 5'))}, 2000 + o_orderkey % 7)
        AS VARCHAR) AS area_id FROM orders)""",
)
def zone_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    area = codes.area_of_zone(standin.pick(standin.ZONE_NAMES, k % 5), 2000 + k % 7)
    rows = standin.read(spark, sf_dir, "orders").select(
        k.alias("k"), F.to_date("o_orderdate").alias("day"), area.alias("area_id")
    )
    region = codes.region_key("NWAC", F.col("area_id"))
    return rows.select(
        "k",
        "area_id",
        region.alias("region_id"),
        codes.run_key(F.col("day"), region).alias("run_key"),
        region.startswith("NWAC.11").alias("mapped"),
    )


@query(
    "summary_fallback",
    """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 2 THEN 'B' || o_orderkey
        WHEN o_orderkey % 5 > 1 THEN 'H' || o_orderkey ELSE '' END AS summary FROM orders""",
)
def summary_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    first = F.when(k % 3 == 1, "").when(k % 3 == 2, F.concat(F.lit("B"), k.cast("string")))
    second = F.when(k % 5 == 1, "").when(k % 5 > 1, F.concat(F.lit("H"), k.cast("string")))
    orders = standin.read(spark, sf_dir, "orders").select(k.alias("k"), first.alias("a"), second.alias("b"))
    return orders.select("k", codes.first_text(F.col("a"), F.col("b")).alias("summary"))


# --- geometry ---------------------------------------------------------------------------------


@query(
    "aspect_components",
    f"WITH geometry AS ({sql.STEPS['geometry']}) SELECT l.m AS mask, l.n AS n, g_sin AS aspect_sin, g_cos AS aspect_cos, "
    "g_range AS aspect_range FROM (SELECT (l_suppkey * 37 + l_partkey) % 256 AS m, count(*) AS n FROM lineitem GROUP BY ALL) l "
    "JOIN geometry g ON g.m = l.m",
)
def aspect_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of eight flag columns of every line, counted per mask."""
    mask = "((l_suppkey * 37 + l_partkey) % 256)"
    lines = standin.read(spark, sf_dir, "lineitem").selectExpr(
        f"{mask} AS mask", *[f"shiftright({mask}, {i}) & 1 AS {name}" for i, name in enumerate(aspects.ASPECTS)]
    )
    parts = aspects.aspect_components(list(aspects.ASPECTS))
    named = lines.select("mask", *[value.alias(f"aspect_{name}") for name, value in parts.items()])
    return named.groupBy("mask", "aspect_sin", "aspect_cos", "aspect_range").agg(F.count(F.lit(1)).alias("n"))


@query(
    "flag_truth",
    "SELECT k, CAST(CASE k % 4 WHEN 1 THEN 0 WHEN 3 THEN 0 WHEN 0 THEN 1 ELSE CASE WHEN k % 8 = 2 THEN 0 ELSE 1 END END AS INTEGER) "
    "AS flag FROM (SELECT o_orderkey AS k FROM orders)",
)
def flag_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of numbers that are one, missing, zero, large and NaN."""
    k = F.col("o_orderkey")
    value = F.when(k % 4 == 0, 1.0).when(k % 8 == 2, 0.0).when(k % 8 == 6, 7.5).when(k % 4 == 3, float("nan"))
    orders = standin.read(spark, sf_dir, "orders").select(k.alias("k"), value.alias("value"))
    return orders.select("k", aspects.flag(F.col("value")).alias("flag"))


# --- normalised bulletins ---------------------------------------------------------------------

_WIDE = "k, " + sql.bulletin_columns()


def landed(spark: SparkSession, sf_dir: str, center: str, keep: str = "k") -> DataFrame:
    """Parsed documents of a centre, stored once as a landing step would.

    The joins have dealt the orders evenly, so the texts are written where they are made.
    """
    build = {"CAIC": standin.caic_documents, "NWAC": standin.nwac_documents}[center]
    stored = materialise(build(spark, sf_dir).select(keep, "document"))
    return bulletins.parse_documents(stored, center, keep=(keep,))


def caic_rows(spark: SparkSession, sf_dir: str, mode: str = "fail") -> DataFrame:
    return normalise.normalise(landed(spark, sf_dir, "CAIC"), "CAIC", mode=mode, keep=("k",))


def nwac_rows(spark: SparkSession, sf_dir: str, mode: str = "quarantine", zones: str = "last") -> DataFrame:
    """Checked rows of the NWAC documents, of which some have no zone."""
    return normalise.normalise(landed(spark, sf_dir, "NWAC"), "NWAC", mode=mode, keep=("k",), zones=zones)


@query("caic_bulletins", sql.with_steps("caic", f"SELECT {_WIDE} FROM caic"))
def caic_bulletins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(caic_rows(spark, sf_dir))


@query("nwac_bulletins", sql.with_steps("nwac", f"SELECT {_WIDE} FROM nwac WHERE area_id IS NOT NULL"))
def nwac_bulletins(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = normalise.split_quarantine(nwac_rows(spark, sf_dir))
    return plain(good)


@query("nwac_all_zones", sql.with_steps("nwac_zones", f"SELECT {_WIDE} FROM nwac_zones"))
def nwac_all_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = normalise.split_quarantine(nwac_rows(spark, sf_dir, zones="all"))
    return plain(good)


@query(
    "quarantined_bulletins",
    sql.with_steps(
        "nwac",
        "SELECT k, CAST(forecast_date AS VARCHAR) AS forecast_date, "
        "'missing region_id; missing area_id; missing polygons' AS problems FROM nwac WHERE area_id IS NULL",
    ),
)
def quarantined_bulletins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulletins without a zone, with what is wrong with them."""
    _, bad = normalise.split_quarantine(nwac_rows(spark, sf_dir))
    return plain(bad.select("k", "forecast_date", F.concat_ws("; ", normalise.ERRORS).alias("problems")))


@query(
    "strict_name_errors",
    f"SELECT count(*) FILTER (WHERE problem = 'icefall') AS unknown_problem, "
    f"count(*) FILTER (WHERE ranged = 'doubtful') AS unknown_likelihood, count(*) FILTER (WHERE problem <> 'icefall' "
    f"AND ranged <> 'doubtful') AS good {_NAMED}",
)
def strict_name_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names no code exists for, as the quarantine mode reports them."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    orders = named_orders(spark, sf_dir, day.alias("text"))
    problem = F.struct(
        F.col("problem").alias("type"),
        F.col("ranged").alias("likelihood"),
        F.struct(F.lit("1").alias("min"), F.lit("2").alias("max")).alias("expectedSize"),
        F.array(F.lit("n_alp")).alias("aspectElevations"),
    )
    document = F.struct(
        F.lit("avalancheForecast").alias("type"),
        F.col("text").alias("expiryDateTime"),
        F.col("text").alias("issueDateTime"),
        F.lit("1").alias("areaId"),
        F.array(F.lit("p")).alias("polygons"),
        F.struct(F.array(F.array(problem)).alias("days")).alias("avalancheProblems"),
    )
    texts = materialise(orders.select("k", F.to_json(document).alias("document")))
    documents = bulletins.parse_documents(texts, "CAIC", keep=("k",))
    checked = normalise.normalise(documents, "CAIC", mode="quarantine", keep=("k",))

    def having(message: str) -> Column:
        return F.count(F.when(F.array_contains(normalise.ERRORS, message), 1))

    return checked.agg(
        having("unknown problem type").alias("unknown_problem"),
        having("unknown likelihood").alias("unknown_likelihood"),
        F.count(F.when(F.size(normalise.ERRORS) == 0, 1)).alias("good"),
    )


@query(
    "combined_centers",
    sql.with_steps(
        "caic nwac",
        "SELECT forecast_center, region_id, avalanche_season, count(*) AS n, CAST(sum(problem_type_0) AS BIGINT) AS type_sum, "
        "CAST(sum(prevalence_0 + prevalence_1 + prevalence_2) AS BIGINT) AS prevalence_sum, "
        "CAST(sum(danger_alp) AS BIGINT) AS danger_sum FROM (SELECT * FROM caic UNION ALL "
        "SELECT * FROM nwac WHERE area_id IS NOT NULL) GROUP BY ALL",
    ),
)
def combined_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both centres in one table, summed up by region and season."""
    good, _ = normalise.split_quarantine(nwac_rows(spark, sf_dir))
    rows = normalise.combine(caic_rows(spark, sf_dir), good)
    return rows.groupBy("forecast_center", "region_id", "avalanche_season").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("problem_type_0").alias("type_sum"),
        F.sum(F.expr("prevalence_0 + prevalence_1 + prevalence_2")).alias("prevalence_sum"),
        F.sum("danger_alp").alias("danger_sum"),
    )


@query(
    "landed_documents",
    sql.with_steps(
        "caic",
        "SELECT CAST(distribution_date AS VARCHAR) AS landed_date, count(*) AS n, CAST(sum(forecast_days_out) AS BIGINT) AS days_out, "
        "CAST(sum(prevalence_0 + prevalence_1 + prevalence_2) AS BIGINT) AS prevalence_sum FROM caic GROUP BY ALL",
    ),
)
def landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON by year, scanned again and normalised."""
    documents = landed(spark, sf_dir, "CAIC", keep="day")
    path = scratch_path(spark, "landing")
    # A folder per month keeps the number of small files of this test layout down.
    bulletins.land_documents(documents.withColumn("distribution_date", F.trunc("day", "month")).drop("day"), path)
    scanned = bulletins.scan_documents(spark, "CAIC", path, lines=True)
    rows = normalise.normalise(scanned, "CAIC", keep=("landed_date",))
    in_folder = rows.where(F.col("landed_date") == F.trunc("distribution_date", "month"))
    return plain(
        in_folder.groupBy(F.col("distribution_date").alias("landed_date")).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("forecast_days_out").alias("days_out"),
            F.sum(F.expr("prevalence_0 + prevalence_1 + prevalence_2")).alias("prevalence_sum"),
        )
    )


@query(
    "landed_arrays",
    sql.with_steps(
        "caic",
        "SELECT CAST(date_trunc('year', distribution_date) AS DATE)::VARCHAR AS landed_date, count(*) AS n, "
        "CAST(sum(forecast_days_out) AS BIGINT) AS days_out, "
        "CAST(sum(prevalence_0 + prevalence_1 + prevalence_2) AS BIGINT) AS prevalence_sum FROM caic GROUP BY ALL",
    ),
)
def landed_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed as one JSON array a year and read again by ranges of a quarter megabyte."""
    path = scratch_path(spark, "landing")
    stored = standin.caic_documents(spark, sf_dir).withColumn("distribution_date", F.trunc("day", "year"))
    bulletins.land_arrays(stored, path, compressed=True)
    scanned = bulletins.scan_documents(spark, "CAIC", path, split_bytes=1 << 18)
    rows = normalise.normalise(scanned, "CAIC", keep=("landed_date",))
    in_file = rows.where(F.col("landed_date") == F.trunc("distribution_date", "year"))
    return plain(
        in_file.groupBy("landed_date").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("forecast_days_out").alias("days_out"),
            F.sum(F.expr("prevalence_0 + prevalence_1 + prevalence_2")).alias("prevalence_sum"),
        )
    )


@query(
    "served_documents",
    "SELECT CAST(request_date AS VARCHAR) AS request_date, count(*) AS n, CAST(sum(k) AS BIGINT) AS key_sum FROM "
    "(SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) - 1 AS request_date FROM orders UNION ALL "
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) FROM orders) GROUP BY ALL",
)
def served_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents the two-day index window serves to each request day."""
    orders = order_days(spark, sf_dir)
    index = orders.select(F.col("k").alias("id"), F.col("day").alias("listed_date"))
    documents = standin.nwac_documents(spark, sf_dir).select(F.col("k").alias("id"), "document")
    served = bulletins.assemble_documents(index, documents)
    return plain(served.groupBy("request_date").agg(F.count("document").alias("n"), F.sum("id").alias("key_sum")))


@query(
    "day_expansion",
    sql.with_steps("caic", "SELECT k, count(*) AS n_days, max(forecast_days_out) AS last_day FROM caic GROUP BY ALL"),
)
def day_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast days of every bulletin: the longer of its two day lists."""
    days = normalise.caic_days(landed(spark, sf_dir, "CAIC"), keep=("k",))
    return days.groupBy("k").agg(F.count(F.lit(1)).alias("n_days"), F.max("day").cast("long").alias("last_day"))


@query(
    "current_danger",
    "SELECT o_orderkey AS k, o_orderkey % 6 AS upper, (o_orderkey // 6) % 6 AS middle, (o_orderkey // 36) % 6 AS lower "
    "FROM orders",
)
def current_danger(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = normalise.current_danger(F.col("danger")).alias("now")
    rows = landed(spark, sf_dir, "NWAC").select("k", now)
    return rows.select("k", "now.upper", "now.middle", "now.lower")


@query(
    "pivoted_slots",
    sql.with_steps(
        "slots",
        "SELECT l_orderkey AS k, " + ", ".join(
            f"coalesce(type_{s}, 0) AS problem_type_{s}, CAST(bit_count(coalesce(alp_{s}, 0)) AS BIGINT) AS alp_prevalence_{s}"
            for s in sql.SLOTS
        ) + " FROM slots",
    ),
)
def pivoted_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long problem rows pivoted to one row per key; slots beyond the third are dropped."""
    lines = standin.read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS k", "l_linenumber - 1 AS slot", "l_partkey % 10 AS kind", "(l_suppkey * 37 + l_partkey) % 256 AS alp"
    )
    wide = normalise.pivot_problems(lines, ["k"], {"problem_type": "kind", "alp_mask": "alp"})
    counts = [f"cast(bit_count(coalesce(alp_mask_{s}, 0)) AS bigint) AS alp_prevalence_{s}" for s in sql.SLOTS]
    return wide.selectExpr("k", *[f"coalesce(problem_type_{s}, 0) AS problem_type_{s}" for s in sql.SLOTS], *counts)


# --- tables, grids and partitions ---------------------------------------------------------------

_KEYS = "region_id, CAST(forecast_date AS VARCHAR) AS forecast_date"


@query(
    "latest_publication",
    sql.with_steps(
        "combined",
        f"SELECT {_KEYS}, epoch_ms(publish_datetime) AS publish_datetime, epoch_ms(analysis_datetime) AS analysis_datetime, "
        "area_name, avalanche_summary, problem_type_0 FROM combined QUALIFY row_number() OVER (PARTITION BY region_id, "
        "forecast_date ORDER BY publish_datetime DESC, analysis_datetime DESC) = 1",
    ),
)
def latest_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.combined(spark, sf_dir).select(
        *tables.KEYS, "publish_datetime", "analysis_datetime", "area_name", "avalanche_summary", "problem_type_0"
    )
    return plain(tables.latest_publication(rows))


@query(
    "lagged_day",
    sql.with_steps(
        "winners",
        "SELECT region_id, CAST(CAST(forecast_date + 1 AS DATE) AS VARCHAR) AS forecast_date, avalanche_season, "
        "forecast_date_season_day_number, CAST(distribution_date AS VARCHAR) AS distribution_date, problem_type_0 FROM winners",
    ),
)
def lagged_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yesterday's bulletin under today's date; season and day number stay yesterday's."""
    columns = ["avalanche_season", "forecast_date_season_day_number", "distribution_date", "problem_type_0"]
    return plain(tables.build_features(standin.combined(spark, sf_dir)).select(*tables.KEYS, *columns))


@query(
    "component_columns",
    sql.with_steps("components", f"SELECT {_KEYS}, " + ", ".join(sql.COMPONENT_COLUMNS) + " FROM components"),
)
def component_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 27 component columns added to rows that keep their 72 flags."""
    winners = tables.latest_publication(tables.same_day_in_season(standin.combined(spark, sf_dir)))
    return plain(tables.with_aspect_components(winners).select(*tables.KEYS, *sql.COMPONENT_COLUMNS))


@query(
    "center_regions",
    sql.with_steps("combined", "SELECT DISTINCT forecast_center, region_id FROM combined"),
)
def center_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.combined(spark, sf_dir)
    return tables.regions_of_centers(rows.select("forecast_center"), tables.region_dimension(rows))


_SERIES = (
    "SELECT region_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS forecast_date FROM "
    "(SELECT DISTINCT region_id FROM combined), (SELECT min(forecast_date) AS lo, max(forecast_date) AS hi FROM combined)"
)


def grid(rows: DataFrame) -> DataFrame:
    return tables.daily_grid(tables.region_dimension(rows), *tables.day_range(rows))


@query(
    "daily_grid",
    sql.with_steps(
        "combined",
        f"SELECT region_id, year(forecast_date) AS year, count(*) AS n_days, CAST(min(forecast_date) AS VARCHAR) AS first_day FROM ({_SERIES}) GROUP BY ALL",
    ).replace("year(forecast_date) AS year", "CAST(year(forecast_date) AS INTEGER) AS year"),
)
def daily_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = grid(standin.combined(spark, sf_dir).select(*tables.KEYS))
    per_year = days.groupBy("region_id", F.year("forecast_date").alias("year"))
    return plain(per_year.agg(F.count(F.lit(1)).alias("n_days"), F.min("forecast_date").alias("first_day")))


@query(
    "season_grid",
    sql.with_steps(
        "combined spans",
        "SELECT region_id, model_year AS season_year, model_year || '/' || (model_year + 1) AS avalanche_season "
        "FROM (SELECT DISTINCT region_id FROM combined), spans",
    ),
)
def season_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.combined(spark, sf_dir).select(*tables.KEYS)
    return tables.season_grid(tables.region_dimension(rows), model_years(spark, sf_dir))


@query(
    "missing_partitions",
    sql.with_steps(
        "winners",
        f"SELECT {_KEYS} FROM ({_SERIES}) g WHERE NOT EXISTS (SELECT 1 FROM winners w WHERE w.region_id = g.region_id "
        "AND w.forecast_date = g.forecast_date)",
    ),
)
def missing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.combined(spark, sf_dir)
    targets = tables.build_targets(rows)
    return plain(tables.missing_partitions(grid(rows.select(*tables.KEYS)), targets).select("region_id", "forecast_date"))


# The request of the partition queries: days and regions with an extreme bulletin.
_REQUEST = "SELECT DISTINCT region_id, forecast_date FROM combined WHERE danger_alp = 5 AND danger_tln = 5"


def request(rows: DataFrame) -> DataFrame:
    return rows.where("danger_alp = 5 AND danger_tln = 5").select(*tables.KEYS).distinct()


@query(
    "partition_values",
    sql.with_steps(
        "combined",
        f"SELECT 'day' AS dimension, CAST(forecast_date AS VARCHAR) AS value FROM ({_REQUEST}) UNION "
        f"SELECT 'region', region_id FROM ({_REQUEST})",
    ),
)
def partition_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    days, regions = tables.partition_values(request(standin.combined(spark, sf_dir)))
    listed = days.select(F.lit("day").alias("dimension"), F.col("forecast_date").cast("string").alias("value"))
    return listed.unionByName(regions.select(F.lit("region").alias("dimension"), F.col("region_id").alias("value")))


_SCANNED = "SELECT region_id, CAST(forecast_date AS VARCHAR) AS forecast_date, problem_type_0, prevalence_0 FROM combined c WHERE "


@query(
    "partition_scan",
    sql.with_steps("combined", _SCANNED + f"(region_id, forecast_date) IN ({_REQUEST})"),
)
def partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.combined(spark, sf_dir)
    columns = [*tables.KEYS, "problem_type_0", "prevalence_0"]
    return plain(tables.scan_partitions(rows, request(rows), tables.KEYS, columns))


@query(
    "partition_scan_rectangle",
    sql.with_steps(
        "combined",
        _SCANNED + f"region_id IN (SELECT region_id FROM ({_REQUEST})) AND forecast_date IN (SELECT forecast_date FROM ({_REQUEST}))",
    ),
)
def partition_scan_rectangle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.combined(spark, sf_dir)
    columns = [*tables.KEYS, "problem_type_0", "prevalence_0"]
    return plain(tables.scan_partitions(rows, request(rows), tables.KEYS, columns, rectangle=True))


@query(
    "empty_request",
    sql.with_steps(
        "combined",
        f"SELECT 'none' AS request, 0::BIGINT AS n, {len(sql.SLOTS)}::BIGINT * 32 + 19 AS n_columns UNION ALL "
        f"SELECT 'all', count(*), {len(sql.SLOTS)}::BIGINT * 32 + 19 FROM combined WHERE forecast_date IS NOT NULL",
    ),
)
def empty_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty request gives no rows but all columns; asking for every key gives everything."""
    rows = standin.combined(spark, sf_dir)

    def counted(name: str, requested: DataFrame) -> DataFrame:
        found = tables.scan_partitions(rows, requested, tables.KEYS)
        return found.agg(F.lit(name).alias("request"), F.count(F.lit(1)).alias("n")).withColumn(
            "n_columns", F.lit(len(found.columns)).cast("long")
        )

    keys = rows.select(*tables.KEYS)
    return counted("none", keys.where("false")).unionByName(counted("all", keys))


@query(
    "stored_day",
    sql.with_steps(
        "components",
        f"SELECT {_KEYS}, " + ", ".join(sql.COMPONENT_COLUMNS) + " FROM components WHERE (region_id, forecast_date) IN "
        "(SELECT region_id, max(forecast_date) FROM components GROUP BY region_id)",
    ),
)
def stored_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every region's last day, each read back from its folder of the stored targets."""
    warehouse = pipeline.Warehouse(spark, scratch_path(spark, "warehouse"), pipeline.MONTH)
    targets = materialise(tables.build_targets(standin.combined(spark, sf_dir), created=standin.created()))
    warehouse.store_daily("targets", targets, targets.select(*tables.KEYS))
    last = targets.groupBy("region_id").agg(F.max("forecast_date").alias("forecast_date"))
    return plain(warehouse.daily_rows("targets", last).select(*tables.KEYS, *sql.COMPONENT_COLUMNS))


@query(
    "run_times",
    sql.with_steps("components", "SELECT 'now' AS run_id, count(*) AS n, 1::BIGINT AS n_times, count(*) AS n_recent FROM components"),
)
def run_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a given creation time all rows of a run carry the one at which it started."""
    targets = tables.build_targets(standin.combined(spark, sf_dir), run_id="now")
    recent = F.unix_seconds(F.current_timestamp()) - F.unix_seconds("creation_datetime") < 86400
    return targets.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("creation_datetime").alias("n_times"),
        F.count(F.when(recent, 1)).alias("n_recent"),
    )


# A stored table of all same-day winners, of which the requested partitions are replaced:
# those whose winner has an odd danger get new rows, the others become empty.
@query(
    "partition_replace",
    sql.with_steps(
        "winners",
        "SELECT region_id, CAST(date_trunc('month', forecast_date) AS DATE)::VARCHAR AS month, CAST(forecast_date AS VARCHAR) AS forecast_date, "
        "problem_type_0 + CASE WHEN problem_type_1 >= 5 THEN 100 ELSE 0 END AS problem_type_0 FROM winners "
        "WHERE problem_type_1 < 5 OR danger_btl % 2 = 1",
    ),
)
def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["region_id", "month", "forecast_date", "problem_type_0"]
    source = tables.latest_publication(tables.same_day_in_season(standin.combined(spark, sf_dir)))
    winners = materialise(
        source.withColumn("month", F.trunc("forecast_date", "month")).select(*columns, "problem_type_1", "danger_btl")
    )
    keys = ["region_id", "month", "forecast_date"]
    path = scratch_path(spark, "replaced")
    storage.replace_partitions(winners.select(*columns), path, winners.select(*keys), keys, ["month"])
    requested = winners.where("problem_type_1 >= 5")
    fresh = requested.where("danger_btl % 2 = 1").withColumn("problem_type_0", F.col("problem_type_0") + 100)
    storage.replace_partitions(fresh.select(*columns), path, requested.select(*keys), keys, ["month"])
    return plain(spark.read.parquet(path).select(*columns))


_REPORT = table(
    ColumnSpec("k", "long"),
    *[ColumnSpec(f"{name}_{s}", "long", 0) for name in ("type", "likelihood") for s in sql.SLOTS],
    *[ColumnSpec(f"quantity_{s}", "double", 0.0) for s in sql.SLOTS],
    ColumnSpec("o_orderpriority", "string", "none"),
    ColumnSpec("region_code", "string"),
)
_REPORTED = [spec.name for spec in _REPORT.columns]


@query(
    "null_report",
    sql.with_steps(
        "bulletin",
        " UNION ALL ".join(
            f"SELECT '{name}' AS column_name, "
            + ("count(*)" if name == "region_code" else f"count(*) - count({name})")
            + " AS null_rows FROM bulletin"
            for name in _REPORTED
        ),
    ),
)
def null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a value for every non-nullable column; an absent column misses all."""
    return null_violations(standin.bulletins(spark, sf_dir), _REPORT)


@query(
    "conformed_rows",
    sql.with_steps(
        "bulletin",
        "SELECT " + ", ".join(
            "k" if s.name == "k"
            else "CAST(NULL AS VARCHAR) AS region_code" if s.name == "region_code"
            else f"coalesce({s.name}, {repr(s.default) if s.kind == 'string' else str(s.default) + ('::DOUBLE' if s.kind == 'double' else '')}) AS {s.name}"
            for s in _REPORT.columns
        ) + " FROM bulletin",
    ),
)
def conformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(standin.bulletins(spark, sf_dir), _REPORT)


# --- training ---------------------------------------------------------------------------------


def model_years(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """Seasons from the first to the last order day."""
    return tables.season_years(*tables.day_range(order_days(spark, sf_dir), "day"))


def winners_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winners both targets and features come from, stored once for the jobs below."""
    return materialise(tables.daily_winners(standin.combined(spark, sf_dir)))


def frame_from(winners: DataFrame) -> DataFrame:
    return training.training_frame([tables.model_inputs_of(winners)], tables.targets_of(winners))


def frame_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame_from(winners_of(spark, sf_dir))


def models_from(spark: SparkSession, sf_dir: str, winners: DataFrame) -> pipeline.TrainedModels:
    return pipeline.train_models(frame_from(winners), model_years(spark, sf_dir))


@query(
    "training_frame",
    sql.with_steps(
        "frame",
        f"SELECT {_KEYS}, season_year, " + ", ".join(f"{c}, target_{c}" for c in sql.MODEL_COLUMNS) + " FROM frame",
    ),
)
def training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(frame_of(spark, sf_dir))


@query(
    "training_targets",
    sql.with_steps(
        "winners spans",
        "SELECT region_id, model_year, count(*) AS n, CAST(sum(problem_type_0) AS BIGINT) AS type_sum, "
        "CAST(max(forecast_date) AS VARCHAR) AS last_day FROM winners JOIN spans "
        "ON forecast_date < make_date(model_year, 9, 1) GROUP BY ALL",
    ),
)
def training_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets dated before each model season: how many, their sum and the last day."""
    targets = tables.build_targets(standin.combined(spark, sf_dir)).withColumn(
        "season_year", cal.season_start_year(F.col("forecast_date"))
    )
    per_season = targets.groupBy("region_id", "season_year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("problem_type_0").alias("type_sum"), F.max("forecast_date").alias("last_day")
    )
    fanned = training.fan_out_training(per_season, model_years(spark, sf_dir), gap=1)
    return plain(
        fanned.groupBy(*training.GROUP).agg(
            F.sum("n").alias("n"), F.sum("type_sum").alias("type_sum"), F.max("last_day").alias("last_day")
        )
    )


@query(
    "training_features",
    sql.with_steps(
        "frame",
        f"SELECT {_KEYS}, problem_type_0, problem_type_1, problem_type_2, aspect_sin_alp_1, target_problem_type_1 FROM frame",
    ),
)
def training_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feature sources and one observed target column joined on their keys."""
    winners = winners_of(spark, sf_dir)
    features = tables.model_inputs_of(winners)
    types = features.select(*tables.KEYS, *training.PROBLEM_COLUMNS)
    components = features.select(*tables.KEYS, "aspect_sin_alp_1")
    observed = training.observed_targets(tables.targets_of(winners), ["problem_type_1"])
    return plain(training.join_sources([types, components, observed]))


@query(
    "split_counts",
    sql.with_steps(
        "frame spans",
        "SELECT region_id, model_year, count(*) FILTER (WHERE season_year <= model_year - 2) AS n_train, "
        "count(*) FILTER (WHERE season_year = model_year - 1) AS n_test FROM frame JOIN spans ON season_year < model_year GROUP BY ALL",
    ),
)
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.split_counts(frame_of(spark, sf_dir), model_years(spark, sf_dir))


@query(
    "slot_match",
    sql.with_steps(
        "frame",
        f"SELECT {_KEYS}, " + ", ".join(
            f"{value} AS x{s}_{i}" for s in sql.SLOTS for i, value in enumerate(sql.matched_sql(f"target_problem_type_{s}"))
        ) + " FROM frame",
    ),
)
def slot_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = [
        f"{value} AS x{s}_{i}" for s in sql.SLOTS for i, value in enumerate(training.match_slot(f"target_problem_type_{s}"))
    ]
    return plain(frame_of(spark, sf_dir).selectExpr(*tables.KEYS, *matched))


def majority_from(spark: SparkSession, sf_dir: str, winners: DataFrame) -> DataFrame:
    counts = training.class_counts(frame_from(winners))
    return training.fit_majority(counts, model_years(spark, sf_dir))


@query(
    "majority_models",
    sql.with_steps(
        "majority",
        "SELECT region_id, model_year, slot, level, k0, k1, k2, array_to_string(ranked, ',') AS ranked, n_rows FROM majority",
    ),
)
def majority_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = majority_from(spark, sf_dir, winners_of(spark, sf_dir))
    return model.withColumn("ranked", F.array_join(F.col("ranked").cast("array<string>"), ","))


@query(
    "tree_models",
    sql.with_steps(
        "trees",
        "SELECT region_id, model_year, slot, node, feature, threshold, CAST(ranked[1] AS BIGINT) AS label, n_rows FROM trees",
    ),
)
def tree_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trees grown for four splits."""
    counts = materialise(training.class_counts(frame_of(spark, sf_dir)))
    grown = trees.fit_trees(counts, model_years(spark, sf_dir), sql.TREE_DEPTH)
    return grown.select(*trees.NODE, "feature", "threshold", F.get("ranked", F.lit(0)).cast("long").alias("label"), "n_rows")


@query(
    "problem_forecasts",
    sql.with_steps("chained", f"SELECT {_KEYS}, p0, p1, p2 FROM chained"),
)
def problem_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    winners = winners_of(spark, sf_dir)
    features = tables.model_inputs_of(winners).select(*tables.KEYS, *training.PROBLEM_COLUMNS)
    scored = scoring.score_problem_types(features, majority_from(spark, sf_dir, winners))
    return plain(scored.select(*tables.KEYS, "p0", "p1", "p2"))


@query(
    "plugin_forecasts",
    sql.with_steps(
        "frame spans scoring_rows",
        f"SELECT {_KEYS}, r.model_year, CAST(m.y AS DOUBLE) AS forecast FROM scoring_rows r JOIN ("
        "SELECT region_id AS region, model_year, target_problem_type_0 AS y, "
        + ", ".join(f"CAST(sum(problem_type_{s}) AS DOUBLE) / count(*) AS m{s}" for s in sql.SLOTS)
        + " FROM frame JOIN spans ON model_year >= season_year + 2 GROUP BY ALL) m "
        "ON m.region = r.region_id AND m.model_year = r.model_year "
        "QUALIFY row_number() OVER (PARTITION BY region_id, forecast_date ORDER BY "
        + " + ".join(f"(problem_type_{s} - m{s}) * (problem_type_{s} - m{s})" for s in sql.SLOTS)
        + ", m.y) = 1",
    ),
)
def plugin_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts of an estimator of another maker, by way of its payloads in the registry."""
    winners = winners_of(spark, sf_dir)
    own = plugins.nearest_mean_estimator("problem_type_0", tuple(training.PROBLEM_COLUMNS))
    store = Registry(spark, scratch_path(spark, "registry"))
    fitted = plugins.fit_estimator(frame_from(winners), own, model_years(spark, sf_dir))
    store.register_payloads(fitted, own.model_name, own.release, ",".join(own.features), "run", created=standin.created())
    models = store.load_payloads(store.deployed(releases={own.model_name: own.release}), own.model_name)
    rows = plugins.in_season_rows(tables.model_inputs_of(winners))
    return plain(plugins.score_estimator(rows, models, own).select(*tables.KEYS, "model_year", "forecast"))


@query(
    "unscored_days",
    sql.with_steps(
        "scoring_rows majority",
        f"SELECT {_KEYS}, model_year FROM scoring_rows WHERE (region_id, model_year) NOT IN "
        "(SELECT region_id, model_year FROM majority)",
    ),
)
def unscored_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    winners = winners_of(spark, sf_dir)
    features = tables.model_inputs_of(winners).select(*tables.KEYS, *training.PROBLEM_COLUMNS)
    return plain(scoring.unscored(features, majority_from(spark, sf_dir, winners)))


def class_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = model_years(spark, sf_dir)
    counts = materialise(training.class_counts(frame_of(spark, sf_dir)))
    return scoring.evaluate_problem_types(counts, training.fit_majority(counts, years), years)


_MODEL = ["model_name", *training.GROUP]


@query(
    "class_metrics",
    sql.with_steps(
        "test_confusion",
        "SELECT model_name, region_id, model_year, n_rows, "
        + ", ".join(f"{sql.rounded(m)} AS {m}" for m in ("accuracy_score", "precision_score", "recall_score", "f1_score"))
        + " FROM (" + sql.classification_sql("test_confusion", "model_name, region_id, model_year") + ")",
    ),
)
def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = evaluate.classification_metrics(class_confusion(spark, sf_dir), _MODEL)
    return rounded(metrics, "accuracy_score", "precision_score", "recall_score", "f1_score")


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n) + sql.OFF_TIE, 4) + 0.0 for n in names})


@query(
    "confusion_matrix",
    sql.with_steps(
        "test_confusion",
        "SELECT g.model_name, g.region_id, g.model_year, t.range AS y_true, p.range AS y_pred, coalesce(c.n, 0) AS n FROM "
        "(SELECT DISTINCT model_name, region_id, model_year FROM test_confusion) g, range(10) t, range(10) p LEFT JOIN test_confusion c "
        "ON c.model_name = g.model_name AND c.region_id = g.region_id AND c.model_year = g.model_year "
        "AND c.y_true = t.range AND c.y_pred = p.range",
    ),
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_matrix(class_confusion(spark, sf_dir), _MODEL)


# --- aspect models ----------------------------------------------------------------------------


def linear_of(spark: SparkSession, sf_dir: str, release: str = "v001") -> DataFrame:
    sums = training.moments(training.design_rows(frame_of(spark, sf_dir), release))
    return training.fit_linear(sums, model_years(spark, sf_dir))


def weight_rows(step: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}_' || slot AS model_name, region_id, model_year, n, {sql.rounded(f'w0[{j}]')} AS intercept, "
        + ", ".join(f"{sql.rounded(f'w[{i}][{j}]')} AS w{i}" for i in range(1, 11))
        + f" FROM {step}"
        for j, name in enumerate(sql.SLOT_COMPONENTS, start=1)
    )


def weight_view(linear: DataFrame) -> DataFrame:
    columns = ["weights[0] AS intercept", *[f"weights[{i}] AS w{i}" for i in range(1, 11)]]
    named = linear_payload(linear).selectExpr(*_MODEL, "n", *columns)
    return rounded(named, "intercept", *[f"w{i}" for i in range(1, 11)])


@query("aspect_models", sql.with_steps("weights", weight_rows("weights")))
def aspect_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of the 27 aspect models of every region and season."""
    return weight_view(linear_of(spark, sf_dir))


@query("incremental_training", sql.with_steps("weights", weight_rows("weights")))
def incremental_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from statistics stored by season: one season is first stored without its even
    days and then reduced again, alone."""
    frame = materialise(frame_of(spark, sf_dir))
    years = model_years(spark, sf_dir)
    seasons, late = list(range(years[0], years[1] + 1)), sum(years) // 2
    kept = SeasonStatistics(spark, scratch_path(spark, "statistics"))
    kept.replace(frame.where((F.col("season_year") != late) | (F.dayofyear("forecast_date") % 2 == 1)), seasons)
    kept.replace(frame, [late])
    return weight_view(fit_linear_stored(kept.moments(), years))


@query("aspect_models_own_slot", sql.with_steps("weights_own", weight_rows("weights_own")))
def aspect_models_own_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the earlier release, which looks at the model's own slot only."""
    return weight_view(linear_of(spark, sf_dir, "v000"))


_LONG_FORECASTS = "(" + " UNION ALL ".join(
    [
        f"SELECT region_id, forecast_date, model_year, 'problem_type_{s}' AS model_name, CAST(p{s} AS DOUBLE) AS forecast FROM forecasts"
        for s in sql.SLOTS
    ]
    + [
        f"SELECT region_id, forecast_date, model_year, '{n}_{s}', forecast_{n}_{s} FROM forecasts"
        for s in sql.SLOTS
        for n in sql.SLOT_COMPONENTS
    ]
) + ")"


@query(
    "prediction_records",
    sql.with_steps(
        "forecasts",
        "SELECT model_name, 'run' AS run_id, " + RUN_KEY.format(day="forecast_date") + f", {CREATED_MS}, "
        "CAST(forecast_date AS VARCHAR) AS forecast_date, region_id, CAST(CAST(forecast_date - 1 AS DATE) AS VARCHAR) AS analysis_date, "
        "model_year || '/' || (model_year + 1) AS avalanche_season, "
        f"{sql.rounded('forecast')} AS forecast, CASE WHEN model_name LIKE 'problem%' THEN 'v000' ELSE 'v001' END AS release, "
        "'models/' || model_name || '.' || model_year || '-' || (model_year + 1) || '.' || region_id || '/versions/1' AS mlflow_model_uri "
        f"FROM {_LONG_FORECASTS}",
    ),
)
def prediction_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain: three problem types, then 27 components that depend on them."""
    winners = winners_of(spark, sf_dir)
    models = models_from(spark, sf_dir, winners)
    forecasts = scoring.score_all(tables.model_inputs_of(winners), models.majority, models.linear)
    return plain(rounded(scoring.prediction_records(forecasts, created=standin.created()), "forecast"))


@query(
    "aspect_gate",
    sql.with_steps(
        "forecasts",
        f"SELECT region_id, model_year, model_name, count(*) AS n, count(*) FILTER (WHERE forecast = 0) AS n_zero, "
        f"{sql.rounded('avg(forecast)')} AS mean_forecast FROM {_LONG_FORECASTS} GROUP BY ALL",
    ),
)
def aspect_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts per model: how many, how many are zero, and their mean."""
    winners = winners_of(spark, sf_dir)
    models = models_from(spark, sf_dir, winners)
    forecasts = scoring.score_all(tables.model_inputs_of(winners), models.majority, models.linear)
    summary = forecasts.groupBy(*training.GROUP, "model_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("forecast") == 0, 1)).alias("n_zero"),
        F.avg("forecast").alias("mean_forecast"),
    )
    return rounded(summary, "mean_forecast")


def regression_output(pairs: str) -> str:
    """Relative errors span many powers of ten, so their logarithm is compared."""
    return (
        "SELECT model_name, region_id, model_year, n_rows, "
        + ", ".join(f"{sql.rounded(m)} AS {m}" for m in ("mae", "rmse", "r2"))
        + f", {sql.rounded('log10(1 + mape)')} AS log_mape FROM ("
        + sql.regression_sql(pairs, "model_name, region_id, model_year")
        + ")"
    )


def regression_view(pairs: DataFrame) -> DataFrame:
    metrics = evaluate.regression_metrics(pairs, _MODEL)
    return rounded(metrics.withColumn("log_mape", F.log10(1 + F.col("mape"))).drop("mape"), "mae", "rmse", "r2", "log_mape")


# Forecasts are rounded first: a relative error of 0 against 1e-17 says nothing.
_TESTED = "(SELECT model_name, region_id, model_year, y_true, round(y_pred, 6) + 0.0 AS y_pred FROM tested_pairs)"


@query("aspect_metrics", sql.with_steps("tested_pairs", regression_output(_TESTED)))
def aspect_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the aspect models on the season before each model season."""
    models = models_from(spark, sf_dir, winners_of(spark, sf_dir))
    return regression_view(models.aspect_pairs().withColumn("y_pred", F.round("y_pred", 6) + 0.0))


# Yesterday's component as the forecast of today's: a baseline both engines compute exactly.
_PERSISTED = "(" + " UNION ALL ".join(
    f"SELECT '{c}' AS model_name, region_id, season_year AS model_year, target_{c} AS y_true, {c} AS y_pred FROM frame"
    for c in sql.COMPONENT_COLUMNS
) + ")"


def persisted_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = frame_of(spark, sf_dir).withColumnRenamed("season_year", "model_year")
    entries = ", ".join(f"'{c}', target_{c}, {c}" for c in sql.COMPONENT_COLUMNS)
    return frame.selectExpr(*training.GROUP, f"stack({len(sql.COMPONENT_COLUMNS)}, {entries}) AS (model_name, y_true, y_pred)")


@query("regression_metrics", sql.with_steps("frame", regression_output(_PERSISTED)))
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regression_view(persisted_pairs(spark, sf_dir))


@query(
    "fitted_lines",
    sql.with_steps(
        "frame",
        "SELECT model_name, region_id, model_year, count(*) AS n_rows, "
        + ", ".join(
            f"CASE WHEN min(y_true) <> max(y_true) THEN {sql.rounded(f'regr_{name}(y_pred, y_true)')} END AS {name}"
            for name in ("slope", "intercept")
        )
        + " "
        f"FROM {_PERSISTED} GROUP BY ALL",
    ),
)
def fitted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.fitted_line(persisted_pairs(spark, sf_dir), _MODEL), "slope", "intercept")


@query(
    "evaluation_rows",
    sql.with_steps("frame", f"SELECT y_true AS y_test, y_pred, count(*) AS n FROM {_PERSISTED} GROUP BY ALL"),
)
def evaluation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(y_test, y_pred) rows written as CSV, read again and counted."""
    path = scratch_path(spark, "evaluation")
    evaluate.write_evaluation_rows(persisted_pairs(spark, sf_dir), path)
    rows = spark.read.option("header", True).schema("y_test double, y_pred double").csv(path)
    return rows.groupBy("y_test", "y_pred").agg(F.count(F.lit(1)).alias("n"))


# --- registry ---------------------------------------------------------------------------------


# The deployed release of every model, written out.
_DEPLOYED = [("problem_type_0", "v000"), ("problem_type_1", "v000"), ("problem_type_2", "v000")] + [
    (f"aspect_{part}_{elevation}_{slot}", "v001")
    for part in ("sin", "cos", "range")
    for elevation in ("alp", "tln", "btl")
    for slot in ("0", "1", "2")
]


@query(
    "deployment_map",
    sql.with_steps(
        "combined",
        "SELECT m.model_name, m.release, g.region_id, count(*) AS n_seasons FROM (SELECT DISTINCT region_id, avalanche_season "
        "FROM combined WHERE avalanche_season <> 'OFF_SEASON') g, (VALUES "
        + ", ".join(f"('{n}', '{r}')" for n, r in _DEPLOYED)
        + ") m(model_name, release) GROUP BY ALL",
    ),
)
def deployment_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured releases of the models of every region and season of the bulletins."""
    rows = standin.combined(spark, sf_dir).where(F.col("avalanche_season") != cal.OFF_SEASON)
    year = F.substring_index("avalanche_season", "/", 1).cast("int")
    groups = rows.select("region_id", year.alias("model_year")).distinct()
    models = describe_models(groups, codes.DEPLOYMENTS).join(F.broadcast(deployments(spark)), ["model_name", "release"])
    return models.groupBy("model_name", "release", "region_id").agg(F.count(F.lit(1)).alias("n_seasons"))


@query(
    "registered_models",
    sql.with_steps(
        "majority",
        "SELECT m.model_name, g.region_id, g.model_year || '/' || (g.model_year + 1) AS avalanche_season, m.release, "
        "m.release || '-deployment' AS alias, m.model_name || '.' || g.model_year || '-' || (g.model_year + 1) || '.' || g.region_id AS model_id, "
        "CAST(CASE WHEN g.last_half THEN 2 ELSE 1 END AS BIGINT) AS version FROM (SELECT DISTINCT region_id, model_year, "
        "model_year >= 1999 AS last_half FROM majority) g, (VALUES "
        + ", ".join(f"('{n}', '{r}')" for n, r in sorted(codes.DEPLOYMENTS.items()))
        + ") m(model_name, release)",
    ),
)
def registered_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All models registered once, and those from 1999 on a second time."""
    models = models_from(spark, sf_dir, winners_of(spark, sf_dir))
    registry = Registry(spark, scratch_path(spark, "registry"))
    registry.register(models.majority, models.linear, "first", created=standin.created())
    later = F.col("model_year") >= 1999
    registry.register(models.majority.where(later), models.linear.where(later), "second", created=standin.created())
    return registry.deployed().select(
        "model_name", "region_id", "avalanche_season", "release", "alias", "model_id", "version"
    )


@query(
    "model_ids",
    sql.with_steps(
        "combined spans",
        "SELECT m.model_name || '.' || s.model_year || '-' || (s.model_year + 1) || '.' || g.region_id AS model_id, "
        "CAST(CASE WHEN m.model_name LIKE 'aspect%' THEN split_part(m.model_name, '_', 4) ELSE NULL END AS INTEGER) AS slot "
        "FROM (SELECT DISTINCT region_id FROM combined) g, spans s, (VALUES "
        + ", ".join(f"('{n}')" for n in sorted(codes.DEPLOYMENTS))
        + ") m(model_name)",
    ),
)
def model_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all models of all regions and seasons, and the slot an aspect model serves."""
    rows = standin.combined(spark, sf_dir).select("region_id")
    groups = tables.season_grid(tables.region_dimension(rows), model_years(spark, sf_dir))
    models = describe_models(groups.select("region_id", F.col("season_year").alias("model_year")), codes.DEPLOYMENTS)
    slots = {name: codes.model_slot(name) for name in codes.ASPECT_MODELS}
    return models.select("model_id", codes.literal_lookup(slots, F.col("model_name")).alias("slot"))


# --- incremental ------------------------------------------------------------------------------

_SHOWN = [f"problem_type_{s}" for s in sql.SLOTS] + [c for c in sql.COMPONENT_COLUMNS if "range" in c]


def monthly_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CAIC documents of the orders with their month, stored once for all landings."""
    documents = standin.caic_documents(spark, sf_dir).withColumn("distribution_date", F.trunc("day", "month"))
    return materialise(documents.select("k", "distribution_date", "document"))


def land_by_month(stored: DataFrame, path: str, only: str = "true") -> None:
    """Land the chosen ones of ``monthly_documents``, one folder a month."""
    documents = bulletins.parse_documents(stored.where(only), "CAIC", keep=("distribution_date",))
    bulletins.land_documents(documents, path)


@query(
    "incremental_targets",
    sql.with_steps("caic_components", f"SELECT {_KEYS}, {', '.join(_SHOWN)} FROM caic_components"),
)
def incremental_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets after two stream runs: the second corrects every landed month.

    First only the bulletins of even keys land, then each month lands again complete.
    """
    root = scratch_path(spark, "warehouse")
    warehouse = pipeline.Warehouse(spark, root, pipeline.MONTH)
    stored = monthly_documents(spark, sf_dir)
    for only in ("k % 2 = 0", "true"):
        land_by_month(stored, f"{root}/landing", only)
        incremental.run_incremental(
            warehouse, "CAIC", f"{root}/landing", f"{root}/progress", created=standin.created(), lines=True
        )
    return plain(warehouse.table("targets").select(*tables.KEYS, *_SHOWN))


@query(
    "incremental_overwrite",
    sql.with_steps("caic_components", f"SELECT {_KEYS}, {', '.join(_SHOWN)} FROM caic_components"),
)
def incremental_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one JSON array per month, written again under its own name and read by ranges."""
    root = scratch_path(spark, "warehouse")
    warehouse = pipeline.Warehouse(spark, root, pipeline.MONTH)
    stored = monthly_documents(spark, sf_dir)
    for only in ("k % 2 = 0", "true"):
        bulletins.land_arrays(stored.where(only), f"{root}/landing", compressed=True)
        incremental.run_incremental(
            warehouse, "CAIC", f"{root}/landing", f"{root}/progress", created=standin.created(), split_bytes=arrays.SPLIT_BYTES
        )
    return plain(warehouse.table("targets").select(*tables.KEYS, *_SHOWN))


class Interrupted(RuntimeError):
    """Stops a run after its tables are stored and before its checkpoint moves on."""


@query(
    "streamed_targets",
    sql.with_steps("caic_components", f"SELECT {_KEYS}, {', '.join(_SHOWN)} FROM caic_components"),
)
def streamed_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets after three runs of the stream over the change log: the second corrects every landed
    month and fails once its tables are stored, the third repeats its batch."""
    root = scratch_path(spark, "warehouse")
    warehouse = pipeline.Warehouse(spark, root, pipeline.MONTH)
    stored = monthly_documents(spark, sf_dir)

    def fail(*_: object) -> None:
        raise Interrupted

    for only, after in (("k % 2 = 0", None), ("true", fail), (None, None)):
        if only:
            land_by_month(stored, f"{root}/landing", only)
            changes.report_landed(spark, f"{root}/landing", f"{root}/log")
        try:
            changes.run_streamed(
                warehouse, "CAIC", f"{root}/log", f"{root}/checkpoint", created=standin.created(), lines=True, stored=after
            )
        except StreamingQueryException as stopped:
            if "Interrupted" not in str(stopped):
                raise
    return plain(warehouse.table("targets").select(*tables.KEYS, *_SHOWN))


@query(
    "streamed_winners",
    sql.with_steps(
        "combined",
        f"SELECT {_KEYS}, epoch_ms(publish_datetime) AS publish_datetime, epoch_ms(analysis_datetime) AS analysis_datetime, "
        "area_name, avalanche_summary, problem_type_0 FROM combined QUALIFY row_number() OVER (PARTITION BY region_id, "
        "forecast_date ORDER BY publish_datetime DESC, analysis_datetime DESC) = 1",
    ),
)
def streamed_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest bulletins after three triggers, to which the bulletins come in no order of time."""
    root = scratch_path(spark, "winners")
    rows = materialise(
        standin.combined(spark, sf_dir).select(
            *tables.KEYS, "publish_datetime", "analysis_datetime", "area_name", "avalanche_summary", "problem_type_0"
        )
    )
    for part in range(3):
        rows.where(F.pmod(F.xxhash64("publish_datetime", "region_id"), F.lit(3)) == part).write.mode("append").parquet(f"{root}/landed")
        winners.run_winners(spark, f"{root}/landed", rows.schema, f"{root}/table", f"{root}/checkpoint")
    return plain(spark.read.parquet(f"{root}/table").select(*rows.columns))


def broken_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NWAC documents of which some are cut short and some have no product type, by landed month."""
    k, text = F.col("k"), F.col("document")
    broken = F.when(k % 13 == 0, F.expr("substring(document, 1, 20)")).when(
        k % 17 == 0, F.regexp_replace(text, '"product_type":"[^"]*",', "")
    )
    rows = standin.nwac_documents(spark, sf_dir).withColumn("document", F.coalesce(broken, text))
    rows = materialise(rows.select(F.trunc("day", "month").alias("landed_date"), "document"))
    return bulletins.parse_documents(rows, "NWAC", keep=("landed_date",))


@query(
    "quarantined_store",
    sql.with_steps(
        "nwac_rows",
        "SELECT CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS landed_date, problems, count(*) AS n FROM ("
        "SELECT d, CASE WHEN area IS NULL THEN 'missing region_id; missing area_id; missing polygons' ELSE '' END AS problems "
        "FROM nwac_rows WHERE k % 13 <> 0 AND k % 17 <> 0 UNION ALL "
        "SELECT d, 'unreadable document or no product type' FROM bulletin WHERE k % 13 = 0 OR k % 17 = 0) GROUP BY ALL",
    ),
)
def quarantined_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows by landed month, and refused ones by what is wrong: texts cut short, documents
    without a product type, and bulletins without a zone."""
    documents = broken_documents(spark, sf_dir)
    warehouse = pipeline.Warehouse(spark, scratch_path(spark, "warehouse"), pipeline.MONTH)
    good, refused = pipeline.checked_rows(documents, "NWAC", created=standin.created(), mode="quarantine")
    requested = materialise(documents.select(F.lit("NWAC").alias("forecast_center"), "landed_date").distinct())
    warehouse.store_combined(good, requested)
    warehouse.store_quarantine(refused, requested)
    stored = warehouse.table("combined").select("landed_date", F.lit("").alias("problems"))
    bad = warehouse.table("quarantine").select("landed_date", F.concat_ws("; ", "problems").alias("problems"))
    return plain(stored.unionByName(bad).groupBy("landed_date", "problems").agg(F.count(F.lit(1)).alias("n")))


@query(
    "refusal_counts",
    sql.with_steps(
        "nwac_rows",
        "SELECT problem, count(*) AS n FROM (SELECT unnest(['missing region_id', 'missing area_id', 'missing polygons']) AS problem "
        "FROM nwac_rows WHERE area IS NULL AND k % 13 <> 0 AND k % 17 <> 0 UNION ALL "
        "SELECT 'unreadable document or no product type' FROM bulletin WHERE k % 13 = 0 OR k % 17 = 0) GROUP BY ALL",
    ),
)
def refusal_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each message was given, once a limit of refusals has let the documents pass."""
    _, refused = pipeline.checked_rows(
        broken_documents(spark, sf_dir), "NWAC", created=standin.created(), mode="quarantine", refusal_limit=10**9
    )
    return refused.select(F.explode("problems").alias("problem")).groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


@query(
    "affected_partitions",
    sql.with_steps(
        "combined",
        "SELECT DISTINCT region_id, CAST(day AS VARCHAR) AS forecast_date FROM (SELECT r.region_id, c.distribution_date AS day FROM "
        "(SELECT DISTINCT forecast_center, distribution_date FROM combined WHERE danger_alp = 5) c JOIN "
        "(SELECT DISTINCT forecast_center, region_id FROM combined) r ON r.forecast_center = c.forecast_center "
        "UNION ALL SELECT region_id, forecast_date FROM combined WHERE danger_alp = 5 AND forecast_days_out = 0)",
    ),
)
def affected_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions and days to recompute when the bulletins with an extreme danger change."""
    rows = standin.combined(spark, sf_dir)
    extreme = rows.where("danger_alp = 5")
    changed = extreme.select("forecast_center", F.col("distribution_date").alias("landed_date")).distinct()
    due = incremental.affected_partitions(changed, extreme.where("forecast_days_out = 0"), tables.region_dimension(rows))
    return plain(due)


@query(
    "backfilled_features",
    sql.with_steps(
        "components",
        "SELECT region_id, CAST(CAST(forecast_date + 1 AS DATE) AS VARCHAR) AS forecast_date, "
        + ", ".join(_SHOWN)
        + " FROM components WHERE CAST(forecast_date + 1 AS DATE) <= (SELECT max(forecast_date) FROM combined)",
    ),
)
def backfilled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of every missing (region, day) of the grid, filled in one pass."""
    warehouse = pipeline.Warehouse(spark, scratch_path(spark, "warehouse"), pipeline.MONTH)
    rows = standin.combined(spark, sf_dir).withColumn("landed_date", F.trunc("distribution_date", "month"))
    rows = materialise(rows)
    warehouse.store_combined(rows, rows.select(*pipeline.COMBINED_FOLDERS).distinct())
    warehouse.backfill(grid(rows.select(*tables.KEYS)), created=standin.created())
    return plain(warehouse.table("features").select(*tables.KEYS, *_SHOWN))
