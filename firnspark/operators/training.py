"""Training frame, time split and the two kinds of grouped models.

All regions, seasons and targets are trained in one job.  Rows are first reduced to
per-season statistics (class counts, moments) with map-side aggregation; only these are
handed on to every model season whose training window holds them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from firnspark.functions import calendar as cal
from firnspark.functions.aspects import COMPONENTS, COMPONENT_COLUMNS, ELEVATIONS, SLOTS
from firnspark.operators.tables import KEYS
from firnspark.session import materialise

PROBLEM_COLUMNS = [f"problem_type_{slot}" for slot in SLOTS]
MODEL_FEATURES = PROBLEM_COLUMNS + COMPONENT_COLUMNS
TARGET_COLUMNS = PROBLEM_COLUMNS + COMPONENT_COLUMNS
GROUP = ["region_id", "model_year"]


# --- frame and split ----------------------------------------------------------------


def join_sources(sources: list[DataFrame]) -> DataFrame:
    """Feature sources side by side, for the keys all of them have."""
    return reduce(lambda left, right: left.join(right, KEYS, "inner"), sources)


def observed_targets(targets: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Targets renamed to ``target_*`` so that they stand beside features of the same name."""
    names = columns or TARGET_COLUMNS
    return targets.selectExpr(*KEYS, *[f"{name} AS target_{name}" for name in names])


def training_frame(
    sources: list[DataFrame], targets: DataFrame, features: list[str] | None = None, columns: list[str] | None = None
) -> DataFrame:
    """Features and observed targets of the days that have both."""
    inputs = join_sources(sources).select(*KEYS, *(features or MODEL_FEATURES))
    frame = inputs.join(observed_targets(targets, columns), KEYS, "inner")
    return frame.withColumn("season_year", cal.season_start_year(F.col("forecast_date")))


def fan_out_training(stats: DataFrame, years: tuple[int, int], gap: int = 2) -> DataFrame:
    """Hand statistics of a season to every model season that trains on it.

    The model of season S trains on seasons up to S-2; S-1 is its test season.  A gap of
    one season covers both, that is, all rows before the first day of S.
    """
    first, last = years
    start = F.greatest(F.col("season_year") + gap, F.lit(first))
    seasons = F.when(start <= last, F.sequence(start, F.lit(last)))
    return stats.withColumn("model_year", F.explode(seasons)).drop("season_year")


def test_season(rows: DataFrame, years: tuple[int, int]) -> DataFrame:
    """Rows of the season before each model season."""
    first, last = years
    return rows.withColumn("model_year", F.col("season_year") + 1).where(
        F.col("model_year").between(first, last)
    )


def expanding_sums(
    stats: DataFrame, keys: list[str], sums: list[str], years: tuple[int, int], gap: int = 2
) -> DataFrame:
    """Sums per key over all seasons up to ``gap`` before each model season, as a range frame.

    Every key gets a row for each model season from its first possible one on, so the frame
    is asked at seasons the key has no rows of; statistics are not copied to later seasons.
    """
    first, last = years
    stats = materialise(stats.select(*keys, "season_year", *sums))
    begin = F.greatest(F.min("season_year") + gap, F.lit(first))
    asked = stats.groupBy(*keys).agg(F.when(begin <= last, F.sequence(begin, F.lit(last))).alias("asked"))
    grid = asked.select(*keys, F.explode("asked").alias("season_year"), F.lit(True).alias("asked"))
    frame = Window.partitionBy(*keys).orderBy("season_year").rangeBetween(Window.unboundedPreceding, -gap)
    rows = stats.withColumn("asked", F.lit(False)).unionByName(grid, allowMissingColumns=True)
    totals = [F.sum(name).over(frame).alias(name) for name in sums]
    summed = rows.select(*keys, "season_year", "asked", *totals).where("asked").drop("asked")
    return summed.withColumnRenamed("season_year", "model_year")


def split_counts(frame: DataFrame, years: tuple[int, int]) -> DataFrame:
    """Training and test rows of every region and model season."""
    counts = materialise(frame.groupBy("region_id", "season_year").agg(F.count(F.lit(1)).alias("n")))
    train = expanding_sums(counts, ["region_id"], ["n"], years).withColumnRenamed("n", "n_train")
    test = test_season(counts, years).select(*GROUP, F.col("n").alias("n_test"))
    both = train.join(test, GROUP, "full")
    return both.select(*GROUP, *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("n_train", "n_test")])


# --- majority models of the problem types ---------------------------------------------


def class_counts(frame: DataFrame) -> DataFrame:
    """Per season: how often each target class follows each tuple of yesterday's codes."""
    codes = [F.col(name).alias(f"k{slot}") for slot, name in enumerate(PROBLEM_COLUMNS)]
    observed = [F.col(f"target_{name}").alias(f"y{slot}") for slot, name in enumerate(PROBLEM_COLUMNS)]
    cells = frame.select("region_id", "season_year", *codes, *observed).groupBy(
        "region_id", "season_year", "k0", "k1", "k2", "y0", "y1", "y2"
    ).agg(F.count(F.lit(1)).alias("n"))
    per_slot = F.explode(F.array(*[F.struct(F.lit(s).alias("slot"), F.col(f"y{s}").alias("y")) for s in SLOTS]))
    long = cells.withColumn("entry", per_slot).select(
        "region_id", "season_year", "k0", "k1", "k2", "entry.slot", "entry.y", "n"
    )
    return long.groupBy("region_id", "season_year", "slot", "k0", "k1", "k2", "y").agg(F.sum("n").alias("n"))


ABSENT = -1  # key part that a coarser level leaves out


def rank_classes(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Classes of every key, most frequent first, smaller class first among equals.

    The list is as long as the number of classes, whatever the number of rows.
    """
    pairs = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col("y"))))
    return counts.groupBy(*keys).agg(
        F.transform(pairs, lambda p: p["y"]).alias("ranked"), F.sum("n").alias("n_rows")
    )


def fit_majority(counts: DataFrame, years: tuple[int, int]) -> DataFrame:
    """Ranked classes per region, season, slot and tuple of codes.

    Problem type 0 looks at yesterday's type 0 alone.  Types 1 and 2 look at all three
    codes; levels 2 and 1 keep the first two and the first code for tuples never seen.
    """
    cells = ["region_id", "slot", "k0", "k1", "k2", "y"]
    windows = expanding_sums(counts, cells, ["n"], years)
    k0, k1, k2 = F.col("k0"), F.col("k1"), F.col("k2")
    gone = F.lit(ABSENT).cast("long")

    def level(depth: int, *parts: Column) -> Column:
        names = [part.alias(f"k{i}") for i, part in enumerate(parts)]
        return F.struct(F.lit(depth).alias("level"), *names)

    one = level(1, k0, gone, gone)
    levels = F.when(F.col("slot") == 0, F.array(one)).otherwise(
        F.array(one, level(2, k0, k1, gone), level(3, k0, k1, k2))
    )
    leveled = windows.withColumn("key", F.explode(levels)).select(*GROUP, "slot", "key.*", "y", "n")
    keys = [*GROUP, "slot", "level", "k0", "k1", "k2"]
    return rank_classes(leveled.groupBy(*keys, "y").agg(F.sum("n").alias("n")), keys)


def resolve_tuples(tuples: DataFrame, model: DataFrame) -> DataFrame:
    """Ranked classes of the three slots for distinct (region, season, codes) tuples.

    A tuple never seen falls back to its first two codes, then to its first code, and a
    first code never seen to the nearest seen one, the lower of two equally near.  Tuples
    of a region and season without a model are dropped.
    """
    per_key = model.groupBy(*GROUP, "level", "k0", "k1", "k2").agg(
        *[F.first(F.when(F.col("slot") == s, F.col("ranked")), ignorenulls=True).alias(f"r{s}") for s in SLOTS]
    )

    def at(depth: int, keep: list[str], prefix: str) -> DataFrame:
        lists = [F.col(f"r{s}").alias(f"{prefix}{s}") for s in SLOTS]
        return per_key.where(F.col("level") == depth).select(*GROUP, *keep, *lists)

    base = at(1, ["k0"], "one_").withColumnRenamed("k0", "near")
    seen = base.groupBy(*GROUP).agg(F.collect_set("near").alias("seen"))
    by_distance = F.array_sort(
        F.transform("seen", lambda s: F.struct(F.abs(s - F.col("k0")).alias("gap"), s.alias("code")))
    )
    return (
        tuples.join(seen, GROUP)
        .withColumn("near", F.get(by_distance, F.lit(0))["code"])
        .drop("seen")
        .join(base, [*GROUP, "near"])
        .join(at(2, ["k0", "k1"], "two_"), [*GROUP, "k0", "k1"], "left")
        .join(at(3, ["k0", "k1", "k2"], "three_"), [*GROUP, "k0", "k1", "k2"], "left")
        .select(
            *tuples.columns,
            F.col("one_0").alias("ranked_0"),
            *[F.coalesce(f"three_{s}", f"two_{s}", f"one_{s}").alias(f"ranked_{s}") for s in (1, 2)],
        )
    )


def first_allowed(ranked: Column, *excluded: Column) -> Column:
    """Most frequent class that is none of the excluded ones, 0 when there is none."""

    def allowed(label: Column) -> Column:
        keep = label != excluded[0]
        for other in excluded[1:]:
            keep = keep & (label != other)
        return keep

    return F.coalesce(F.get(F.filter(ranked, allowed), F.lit(0)), F.lit(0))


def chain_problem_types(resolved: DataFrame) -> DataFrame:
    """Forecasts 0, 1, 2 in order: a slot after an empty slot is empty, and no type repeats."""
    p0, p1 = F.col("p0"), F.col("p1")
    return (
        resolved.withColumn("p0", F.get("ranked_0", F.lit(0)))
        .withColumn("p1", F.when(p0 == 0, 0).otherwise(first_allowed(F.col("ranked_1"), p0)))
        .withColumn("p2", F.when((p0 == 0) | (p1 == 0), 0).otherwise(first_allowed(F.col("ranked_2"), p0, p1)))
    )


# --- least squares for the aspect components ------------------------------------------

SLOT_COMPONENTS = [f"aspect_{component}_{elevation}" for elevation in ELEVATIONS for component in COMPONENTS]
WIDTH = 1 + len(SLOT_COMPONENTS)
N_TARGETS = len(SLOT_COMPONENTS)


def match_slot(problem_type: str) -> list[str]:
    """Inputs of an aspect model: the problem type, and the nine components of the first of
    yesterday's slots that has this type (zeros when none has).  SQL text by column name."""
    matched = []
    for name in SLOT_COMPONENTS:
        arms = " ".join(f"WHEN problem_type_{slot} = {problem_type} THEN {name}_{slot}" for slot in SLOTS)
        matched.append(f"CASE {arms} ELSE 0.0D END")
    return [f"cast({problem_type} AS double)", *matched]


def same_slot(slot: int) -> list[str]:
    """Inputs of the earlier release: yesterday's type and components of the same slot."""
    return [f"cast(problem_type_{slot} AS double)", *[f"{name}_{slot}" for name in SLOT_COMPONENTS]]


def design(release: str, slot: int, problem_type: str) -> list[str]:
    if release == "v001":
        return match_slot(problem_type)
    if release == "v000":
        return same_slot(slot)
    raise ValueError(f"unknown aspect model release {release!r}")


OBSERVED_TYPES = [f"target_{name}" for name in PROBLEM_COLUMNS]


def design_rows(
    rows: DataFrame,
    release: str = "v001",
    types: list[str] = OBSERVED_TYPES,
    keep: tuple[str, ...] = ("region_id", "season_year"),
    observed: bool = True,
) -> DataFrame:
    """Three rows per input row, one per slot: its problem type p, the model inputs x0..x9
    and, where ``observed``, the targets y0..y8."""
    entries = []
    for slot in SLOTS:
        fields = [f"'slot', {slot}", f"'p', {types[slot]}"]
        fields += [f"'x{i}', {value}" for i, value in enumerate(design(release, slot, types[slot]))]
        if observed:
            fields += [f"'y{j}', target_{name}_{slot}" for j, name in enumerate(SLOT_COMPONENTS)]
        entries.append(f"named_struct({', '.join(fields)})")
    return rows.selectExpr(*keep, f"inline(array({', '.join(entries)}))")


PAIRS = [(i, j) for i in range(WIDTH) for j in range(i, WIDTH)]
CROSS = [(i, j) for i in range(WIDTH) for j in range(N_TARGETS)]
MOMENTS = (
    [f"sx_{i}" for i in range(WIDTH)]
    + [f"sxx_{i}_{j}" for i, j in PAIRS]
    + [f"sy_{j}" for j in range(N_TARGETS)]
    + [f"sxy_{i}_{j}" for i, j in CROSS]
)


def moments(rows: DataFrame) -> DataFrame:
    """Sums that determine the least-squares fits, once per slot for its nine targets."""
    sums = ["count(1) AS n"]
    sums += [f"sum(x{i}) AS sx_{i}" for i in range(WIDTH)]
    sums += [f"sum(x{i} * x{j}) AS sxx_{i}_{j}" for i, j in PAIRS]
    sums += [f"sum(y{j}) AS sy_{j}" for j in range(N_TARGETS)]
    sums += [f"sum(x{i} * y{j}) AS sxy_{i}_{j}" for i, j in CROSS]
    return rows.groupBy("region_id", "season_year", "slot").agg(*[F.expr(text) for text in sums])


# Eigenvalues below this share of the largest moment count as zero: unused flags get weight 0.
RANK_TOLERANCE = 1e-11

LINEAR_SCHEMA = "region_id string, model_year int, slot int, n long, rank int, weights array<array<double>>"


def solve_batch(n: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum-norm least squares from moments: weights (batch, target, 1 + input) and ranks."""
    cut = np.cumsum([WIDTH, len(PAIRS), N_TARGETS])
    sx, sxx, sy, sxy = np.split(sums, cut, axis=1)
    count = n[:, None, None]
    xx = np.zeros((len(n), WIDTH, WIDTH))
    upper = tuple(np.array(PAIRS).T)
    xx[:, upper[0], upper[1]] = sxx
    xx[:, upper[1], upper[0]] = sxx
    xx -= sx[:, :, None] * sx[:, None, :] / count
    xy = sxy.reshape(-1, WIDTH, N_TARGETS) - sx[:, :, None] * sy[:, None, :] / count
    values, vectors = np.linalg.eigh(xx)
    # The raw second moments set the scale of rounding, also when all rows are alike.
    scale = np.maximum(values[:, -1:], np.max(sxx, axis=1, keepdims=True))
    kept = values > RANK_TOLERANCE * scale
    inverse = np.where(kept, 1.0 / np.where(kept, values, 1.0), 0.0)
    coefficients = vectors @ (inverse[:, :, None] * (vectors.transpose(0, 2, 1) @ xy))
    intercept = (sy - np.einsum("bi,bij->bj", sx, coefficients)) / n[:, None]
    weights = np.concatenate([intercept[:, None, :], coefficients], axis=1).transpose(0, 2, 1)
    return weights, kept.sum(axis=1)


def solve_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if batch.empty:
            continue
        n = batch["n"].to_numpy(dtype=float)
        weights, rank = solve_batch(n, np.stack(batch["sums"].to_numpy()))
        out = batch[["region_id", "model_year", "slot", "n"]].copy()
        out["rank"] = rank.astype("int32")
        out["weights"] = [[list(row) for row in matrix] for matrix in weights]
        yield out


def fit_linear(per_season: DataFrame, years: tuple[int, int]) -> DataFrame:
    """One row per region, season and slot: weights of its nine aspect models.

    Every row of the input of the solver holds all moments of one model group, so the
    small solves run batch by batch wherever the rows are.
    """
    summed = expanding_sums(per_season, ["region_id", "slot"], ["n", *MOMENTS], years)
    packed = summed.selectExpr(*GROUP, "slot", "n", f"array({', '.join(MOMENTS)}) AS sums")
    return packed.mapInPandas(solve_batches, LINEAR_SCHEMA)


def linear_value(weights: str, inputs: list[str]) -> str:
    """Intercept plus dot product of one weight array, as SQL text."""
    return " + ".join([f"get({weights}, 0)", *[f"get({weights}, {i}) * {x}" for i, x in enumerate(inputs, start=1)]])
