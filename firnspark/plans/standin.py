"""The general-purpose test tables seen as bulletins.

Orders play the bulletins, their customers' regions the forecast regions, and the lines
of an order its avalanche problems; what is beyond a schema's slots, the normalisers drop.  Everything is a plain view over the tables,
so the work of a query grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from firnspark.functions import calendar as cal
from firnspark.functions.aspects import ASPECTS, ELEVATIONS, SLOTS
from firnspark.schema import COMBINED, conform, stamp
from firnspark.session import configure

# Orders have up to seven lines.
LINES = tuple(range(7))
CREATED = "2024-01-01 00:00:00"

# Spellings the stand-in documents use, by code.
RISK_NAMES = ["noForecast", "low", "moderate", "considerable", "high", "extreme", "unheard", ""]
PROBLEM_NAMES = ["", "dryLoose", "stormSlab", "windSlab", "persistentSlab", "deepPersistentSlab", "wetLoose", "wetSlab", "cornice", "glide"]
RANGED_LIKELIHOODS = ["", "unlikely", "possible_likely", "likely", "veryLikely_almostCertain", "certain"]
SPACED_LIKELIHOODS = ["", "unlikely", "possible", "likely", "very likely", "almost certain"]
ZONE_NAMES = ["Olympics", "West Slopes North", "Stevens Pass", "Mt Hood", "Elsewhere"]
ASPECT_WORDS = ["north", "northeast", "east", "southeast", "south", "southwest", "west", "northwest"]
ELEVATION_WORDS = ["upper", "middle", "lower"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def created() -> Column:
    return F.lit(CREATED).cast("timestamp")


def line_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem values of the lines of every order.

    Repeated line numbers are reduced by ``max``, which aggregates before the shuffle.
    """
    part, supplier, order = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey")
    values = {
        "type": part % 10,
        "alp": (supplier * 37 + part) % 256,
        "tln": (supplier * 53 + part * 3) % 256,
        "btl": (part * 11 + order) % 256,
        "likelihood": 1 + part % 5,
        "quantity": F.col("l_quantity"),
    }
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        *[
            F.max(F.when(F.col("l_linenumber") == slot + 1, value)).alias(f"{name}_{slot}")
            for slot in LINES
            for name, value in values.items()
        ]
    )


def bulletins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their region key and line slots."""
    orders = read(spark, sf_dir, "orders")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    slots = line_slots(spark, sf_dir)
    return placed.join(slots, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumns(
        {"k": F.col("o_orderkey"), "at": F.col("o_orderdate").cast("timestamp")}
    )


def plus_seconds(moment: Column, seconds: Column) -> Column:
    return F.timestamp_seconds(F.unix_seconds(moment) + seconds)


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide combined table, one row per order."""
    k, region = F.col("k"), F.col("n_regionkey").cast("string")
    center = F.concat(F.lit("C"), (F.col("n_regionkey") % 2).cast("string"))
    published = plus_seconds(F.col("at"), k % 86400)
    day = F.to_date("at")
    out = (k % 3).cast("int")
    keys = {
        "publish_datetime": published,
        "region_id": F.concat(center, F.lit("."), region),
        "forecast_center": center,
        "analysis_datetime": plus_seconds(published, F.floor(k / 86400)),
        "distribution_date": F.date_sub(day, out),
        "forecast_date": day,
        "forecast_days_out": out,
        "forecast_date_season_day_number": cal.season_day_number(day),
        "avalanche_season": cal.season(day),
        "area_name": F.when(k % 11 != 0, F.concat(F.lit("Zone "), region)),
        "area_id": region,
        "polygons": F.concat(F.lit("p"), region),
        "avalanche_summary": F.col("o_orderpriority"),
    }
    values = ["k % 6 AS danger_alp", "floor(k / 6) % 6 AS danger_tln", "floor(k / 36) % 6 AS danger_btl"]
    for slot in SLOTS:
        values += [
            f"type_{slot} AS problem_type_{slot}",
            f"likelihood_{slot}",
            f"quantity_{slot} / 10 AS min_size_{slot}",
            f"quantity_{slot} / 5 AS max_size_{slot}",
        ]
        for elevation in ELEVATIONS:
            mask = f"coalesce({elevation}_{slot}, 0)"
            for position, aspect in enumerate(ASPECTS):
                values.append(f"shiftright({mask}, {position}) & 1 AS {aspect}_{elevation}_{slot}")
            values.append(f"bit_count({mask}) AS {elevation}_prevalence_{slot}")
        total = " + ".join(f"bit_count(coalesce({elevation}_{slot}, 0))" for elevation in ELEVATIONS)
        values.append(f"{total} AS prevalence_{slot}")
    named = [value.alias(name) for name, value in keys.items()]
    rows = bulletins(spark, sf_dir).select(*named, *[F.expr(value) for value in values])
    key = F.concat_ws("|", F.date_format("distribution_date", "yyyy-MM-dd"), F.col("forecast_center"))
    return conform(stamp(rows, "run", key, created()), COMBINED)


# --- raw documents ----------------------------------------------------------------


def pick(names: list[str], index: Column) -> Column:
    return F.get(F.lit(names), index.cast("int"))


def names_of_masks(slot: int, aspects: list[str], elevations: list[str], joiner: str) -> Column:
    """Names of the set bits of a slot's three masks, for every four bits from a table of their 16 values."""

    def table(names: list[str]) -> str:
        lists = [[f"'{name}'" for bit, name in enumerate(names) if value >> bit & 1] for value in range(16)]
        return ", ".join(f"array({', '.join(own)})" for own in lists)

    parts = []
    for elevation, word in zip(ELEVATIONS, elevations, strict=True):
        for low in (0, 4):
            names = [f"{aspect}{joiner}{word}" for aspect in aspects[low : low + 4]]
            value = f"cast(shiftright(coalesce({elevation}_{slot}, 0), {low}) & 15 AS int)"
            parts.append(f"get(array({table(names)}), {value})")
    return F.expr(f"concat({', '.join(parts)})")


def has_problem(slot: int) -> Column:
    return F.coalesce(F.col(f"type_{slot}"), F.lit(0)) != 0


def caic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, day, document): one JSON text per order, shaped like a CAIC bulletin."""
    k, region, at = F.col("k"), F.col("n_regionkey").cast("string"), F.col("at")

    def listed(slot: int) -> Column:
        """Names of the set flags, with a name beyond the flags and a repeated one."""
        extra = F.when(k % 5 == 0, F.array(F.lit("x_alp"))).otherwise(F.array().cast("array<string>"))
        names = F.concat(F.col(f"set_{slot}"), extra)
        return F.concat(names, F.slice(names, F.lit(1), F.when(k % 7 == 0, 1).otherwise(0)))

    def problem(slot: int) -> Column:
        names = F.col(f"names_{slot}")
        present = has_problem(slot)
        full = F.struct(
            F.when(present, pick(PROBLEM_NAMES, F.col(f"type_{slot}"))).alias("type"),
            F.when(present, pick(RANGED_LIKELIHOODS, F.col(f"likelihood_{slot}"))).alias("likelihood"),
            F.when(
                present,
                F.struct(
                    (F.col(f"quantity_{slot}") / 10).cast("string").alias("min"),
                    (F.col(f"quantity_{slot}") / 5).alias("max"),
                ),
            ).alias("expectedSize"),
            F.when(present, names).alias("aspectElevations"),
        )
        # An absent problem is a null in even slots and an empty object in odd ones.
        return full if slot % 2 else F.when(present, full)

    def rating(day: int) -> Column:
        return F.struct(
            pick(RISK_NAMES, (k + day) % 8).alias("alp"),
            pick(RISK_NAMES, (F.floor(k / 2) + day) % 8).alias("tln"),
            pick(RISK_NAMES, (F.floor(k / 3) + day) % 8).alias("btl"),
        )

    first_day = F.array(*[problem(slot) for slot in LINES])
    second_day = F.array(F.when(F.lit(False), problem(0)), *[problem(slot) for slot in LINES[1:]])
    # Half-hour steps through the day, told apart by seconds.
    issued = plus_seconds(at, (k % 48) * 1800 + F.floor(k / 48) % 1800)
    whole = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    fraction = "yyyy-MM-dd'T'HH:mm:ss'.250Z'"

    def text(moment: Column) -> Column:
        return F.when(k % 2 == 0, F.date_format(moment, whole)).otherwise(F.date_format(moment, fraction))

    document = F.struct(
        F.when(k % 10 == 9, "regionalDiscussion").when(k % 10 == 8, "AvalancheForecast").otherwise("avalancheForecast").alias("type"),
        text(plus_seconds(at, F.lit(57600))).alias("expiryDateTime"),
        text(issued).alias("issueDateTime"),
        region.alias("areaId"),
        F.when(k % 4 != 0, F.concat(F.lit("Zone "), region)).alias("title"),
        F.array(F.concat(F.lit("p"), region), F.concat(F.lit("q"), (k % 3).cast("string"))).alias("polygons"),
        F.struct(
            F.slice(
                F.array(*[F.struct(F.concat(F.lit(letter), k.cast("string")).alias("content")) for letter in "ST"]),
                F.lit(1),
                (1 + k % 2).cast("int"),
            ).alias("days")
        ).alias("avalancheSummary"),
        F.struct(F.slice(F.array(*[rating(d) for d in range(3)]), F.lit(1), (k % 4).cast("int")).alias("days")).alias("dangerRatings"),
        F.struct(F.slice(F.array(first_day, second_day), F.lit(1), (F.floor(k / 4) % 3).cast("int")).alias("days")).alias("avalancheProblems"),
    )
    rows = bulletins(spark, sf_dir).withColumns(
        {f"set_{slot}": names_of_masks(slot, list(ASPECTS), list(ELEVATIONS), "_") for slot in LINES}
    ).withColumns({f"names_{slot}": listed(slot) for slot in LINES})
    return rows.select("k", F.to_date("at").alias("day"), F.to_json(document).alias("document"))


def nwac_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, day, document): one JSON text per order, shaped like an NWAC bulletin."""
    k, at = F.col("k"), F.col("at")
    offset = F.when(k % 2 == 0, "+00:00").otherwise("-08:00")
    wall = plus_seconds(at, (k % 24) * 3600)
    later = plus_seconds(wall, F.lit(3600))

    def problem(slot: int) -> Column:
        # The fourth problem takes a rank once more, later ones have ranks beyond the slots.
        rank = k % 3 + 1 if slot == 3 else F.lit(slot + 1).cast("long")
        return F.when(
            has_problem(slot),
            F.struct(
                rank.alias("rank"),
                F.col(f"type_{slot}").alias("avalanche_problem_id"),
                pick(SPACED_LIKELIHOODS, F.col(f"likelihood_{slot}")).alias("likelihood"),
                F.array(F.col(f"quantity_{slot}") / 10, F.col(f"quantity_{slot}") / 5).alias("size"),
                names_of_masks(slot, ASPECT_WORDS, ELEVATION_WORDS, " ").alias("location"),
            ),
        )

    def danger(day: str, *levels: Column) -> Column:
        named = [level.cast("long").alias(name) for level, name in zip(levels, ELEVATION_WORDS)]
        return F.struct(F.lit(day).alias("valid_day"), *named)

    five, none = F.lit(5), F.lit(0)
    zones = F.array(
        *[
            F.struct(
                (2000 + k % 7).alias("id"),
                pick(ZONE_NAMES, index).alias("name"),
                F.concat(F.lit(letter), (k % 9).cast("string")).alias("zone_id"),
            )
            for letter, index in (("y", k % 5), ("z", F.floor(k / 5) % 5))
        ]
    )
    document = F.struct(
        F.when(k % 10 == 7, "Warning").when(k % 10 == 6, "FORECAST").otherwise("forecast").alias("product_type"),
        F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"), offset).alias("published_time"),
        F.concat(F.date_format(later, "yyyy-MM-dd'T'HH:mm:ss'.250000'"), offset).alias("updated_at"),
        F.when(k % 3 == 1, "").when(k % 3 == 2, F.concat(F.lit("B"), k.cast("string"))).alias("bottom_line"),
        F.when(k % 5 == 1, "").when(k % 5 > 1, F.concat(F.lit("H"), k.cast("string"))).alias("hazard_discussion"),
        F.array(
            danger("tomorrow", five, five, five),
            danger("current", k % 6, F.floor(k / 6) % 6, F.floor(k / 36) % 6),
            danger("current", none, none, none),
        ).alias("danger"),
        F.array_compact(F.array(*[problem(slot) for slot in LINES])).alias("forecast_avalanche_problems"),
        F.slice(zones, F.lit(1), (k % 3).cast("int")).alias("forecast_zone"),
    )
    return bulletins(spark, sf_dir).select("k", F.to_date("at").alias("day"), F.to_json(document).alias("document"))
