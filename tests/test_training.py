import numpy as np
import pytest
from pyspark.sql import functions as F

from firnspark.functions import calendar as cal
from firnspark.operators import scoring, tables, training
from firnspark.plans import catalogue
from firnspark.session import materialise

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def winners(spark):
    return catalogue.winners_of(spark, "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def models(spark, winners):
    return catalogue.models_from(spark, "/root/testdata/sf0.01", winners)


def test_training_days_precede_test_days(spark, models):
    frame = models.frame
    train = training.fan_out_training(frame.select("region_id", "season_year", "forecast_date"), models.years)
    late = train.where(F.col("forecast_date") >= cal.season_first_day(F.col("model_year") - 1))
    assert late.count() == 0
    test = training.test_season(frame, models.years)
    outside = test.where(
        (F.col("forecast_date") < cal.season_first_day(F.col("model_year") - 1))
        | (F.col("forecast_date") >= cal.season_first_day(F.col("model_year")))
    )
    assert outside.count() == 0


@pytest.mark.parametrize("release", ["v001", "v000"])
def test_weights_are_minimum_norm_least_squares(spark, models, release):
    rows = training.design_rows(models.frame, release)
    fitted = training.fit_linear(training.moments(rows), models.years).collect()
    data = rows.toPandas()
    ranks = set()
    for model in fitted:
        part = data[
            (data.region_id == model.region_id) & (data.slot == model.slot) & (data.season_year <= model.model_year - 2)
        ]
        assert len(part) == model.n
        x = part[[f"x{i}" for i in range(10)]].to_numpy(dtype=float)
        y = part[[f"y{j}" for j in range(9)]].to_numpy()
        expected, *_ = np.linalg.lstsq(x - x.mean(0), y - y.mean(0), rcond=1e-9)
        weights = np.array(model.weights)
        np.testing.assert_allclose(weights[:, 1:].T, expected, atol=1e-6)
        np.testing.assert_allclose(weights[:, 0], y.mean(0) - x.mean(0) @ expected, atol=1e-6)
        ranks.add(model["rank"])
    assert len(ranks) > 2  # full and deficient groups both occur


def test_constant_and_empty_columns_get_no_weight():
    x = np.zeros((50, 10))
    x[:, 0] = 3.0
    x[:, 1] = 1 / 3
    x[:, 2] = np.arange(50) % 2
    y = np.tile((2 * x[:, 2] + 0.1)[:, None], 9)
    sums = np.concatenate(
        [x.sum(0), [x[:, i] @ x[:, j] for i, j in training.PAIRS], y.sum(0), [x[:, i] @ y[:, j] for i, j in training.CROSS]]
    )
    weights, rank = training.solve_batch(np.array([50.0]), sums[None, :])
    assert rank[0] == 1
    np.testing.assert_allclose(weights[0, 0], [0.1, 0, 0, 2.0] + [0] * 7, atol=1e-9)


def test_slot_matching_examples(spark):
    names = training.SLOT_COMPONENTS
    rows = []
    for predicted, kinds in ((1, (1, 2, 3)), (4, (2, 3, 4)), (7, (5, 1, 2)), (2, (2, 2, 0))):
        rows.append([predicted, *kinds] + [float(10 * slot + 1) for slot in range(3) for _ in names])
    columns = ["t", *training.PROBLEM_COLUMNS] + [f"{n}_{s}" for s in range(3) for n in names]
    df = spark.createDataFrame(rows, columns)
    matched = df.selectExpr(*[f"{v} AS x{i}" for i, v in enumerate(training.match_slot("t"))])
    assert sorted((r.x0, r.x1, r.x9) for r in matched.collect()) == [
        (1.0, 1.0, 1.0),
        (2.0, 1.0, 1.0),
        (4.0, 21.0, 21.0),
        (7.0, 0.0, 0.0),
    ]


def counts(spark, *cells):
    return spark.createDataFrame(
        [("R", 2000, slot, *key, y, n) for slot, key, y, n in cells],
        "region_id string, season_year int, slot int, k0 long, k1 long, k2 long, y long, n long",
    )


def test_majority_fallbacks(spark):
    cells = [(0, (1, 1, 1), 3, 2), (0, (1, 2, 1), 2, 2), (0, (5, 1, 1), 4, 1)]
    for slot in (1, 2):
        cells += [(slot, (1, 1, 1), 3, 5), (slot, (1, 1, 2), 2, 9), (slot, (1, 2, 1), 7, 20), (slot, (5, 1, 1), 4, 1)]
    model = training.fit_majority(counts(spark, *cells), (2000, 2002))
    asked = [(1, 1, 1), (1, 1, 9), (1, 8, 8), (3, 0, 0), (4, 0, 0)]
    tuples = spark.createDataFrame([("R", 2002, *t) for t in asked], "region_id string, model_year int, k0 long, k1 long, k2 long")
    top = {
        (r.k0, r.k1, r.k2): (r.ranked_0[0], r.ranked_1[0]) for r in training.resolve_tuples(tuples, model).collect()
    }
    assert top == {
        (1, 1, 1): (2, 3),  # equal counts: smaller class; exact tuple
        (1, 1, 9): (2, 2),  # first two codes
        (1, 8, 8): (2, 7),  # first code
        (3, 0, 0): (2, 7),  # nearest seen code, lower of two equally near
        (4, 0, 0): (4, 4),
    }
    early = tuples.withColumn("model_year", F.lit(2001))
    assert training.resolve_tuples(early, model).count() == 0


def test_chain_never_repeats_a_type(spark):
    ranked = spark.createDataFrame(
        [([1], [1, 2], [2, 1, 3]), ([0], [1], [2]), ([4], [4], [5]), ([3], [0, 3], [1])],
        "ranked_0 array<long>, ranked_1 array<long>, ranked_2 array<long>",
    )
    out = [(r.p0, r.p1, r.p2) for r in training.chain_problem_types(ranked).collect()]
    assert out == [(1, 2, 3), (0, 0, 0), (4, 0, 0), (3, 0, 0)]


def test_forecasts_keep_the_rules(spark, winners, models):
    forecasts = scoring.score_all(tables.model_inputs_of(winners), models.majority, models.linear)
    wide = materialise(forecasts).groupBy("region_id", "forecast_date").pivot("model_name").agg(F.first("forecast"))
    types = [F.col(f"problem_type_{s}") for s in range(3)]
    repeated = ((types[0] == types[1]) & (types[0] != 0)) | ((types[1] == types[2]) & (types[1] != 0))
    assert wide.where(repeated | ((types[0] == types[2]) & (types[0] != 0))).count() == 0
    for slot in range(3):
        ungated = (types[slot] == 0) & (F.col(f"aspect_range_alp_{slot}") != 0)
        assert wide.where(ungated).count() == 0
    assert forecasts.select("model_name").distinct().count() == 30


def test_every_in_season_day_is_scored_or_reported(spark, winners, models):
    features = tables.model_inputs_of(winners)
    scored = scoring.score_problem_types(features, models.majority).count()
    missed = scoring.unscored(features, models.majority).count()
    assert scored + missed == features.where(cal.in_season(F.col("forecast_date"))).count()


def test_families(spark, models):
    from firnspark.operators import families

    family = families.family_of("aspect_sin_alp_0", "v000")
    model = materialise(family.fit(models.frame, models.years))
    assert family.metrics(models.frame, model, models.years).select("model_name").distinct().count() == 27
    majority = families.family_of("problem_type_2")
    fitted = materialise(majority.fit(models.frame, models.years))
    assert majority.metrics(models.frame, fitted, models.years).count() == models.classification().count()
    with pytest.raises(ValueError):
        families.family_of("aspect_sin_alp_0", "v009")
    with pytest.raises(ValueError):
        families.family_of("aspect_tan_alp_0")
