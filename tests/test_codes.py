import pytest
from pyspark.sql import functions as F

from firnspark.functions import codes


def values(spark, function, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("t"))).collect()]


def test_risk_is_lenient(spark):
    assert values(spark, codes.risk_code, ["high", "EXTREME", "", "odd", None]) == [4, 5, 0, 0, 0]


def test_problem_is_strict(spark):
    assert values(spark, codes.problem_code, ["dryLoose", "looseDry", "glide", "odd"]) == [1, 1, 9, None]


def test_likelihoods(spark):
    ranged = ["possible_likely", "certain", "almostCertain", "odd"]
    assert values(spark, codes.likelihood_code_ranged, ranged) == [2, 5, 5, None]
    assert values(spark, codes.likelihood_code_spaced, ["almost certain", "Very Likely", "odd"]) == [5, 4, None]


def test_phrases(spark):
    phrases = ["northeast upper", "south lower", "northwest middle", "flat upper", "eastern upper"]
    assert values(spark, codes.phrase_to_flag, phrases) == ["ne_alp", "s_btl", "nw_tln", "flat_alp", "eern_alp"]


def test_zone_lookup_falls_back_to_posted_id(spark):
    area = lambda name: codes.area_of_zone(name, F.lit("77"))
    assert values(spark, area, ["Mt Hood", "Elsewhere", None]) == ["1140", "77", "77"]


def test_first_text(spark):
    fallback = lambda t: codes.first_text(t, F.lit("discussion"))
    assert values(spark, fallback, ["line", "", None]) == ["line", "discussion", "discussion"]


def test_models():
    assert len(codes.ASPECT_MODELS) == 27 and len(codes.DEPLOYMENTS) == 30
    assert codes.model_slot("aspect_cos_tln_2") == 2
    for bad in ("aspect_tan_tln_2", "problem_type_0"):
        with pytest.raises(ValueError):
            codes.model_slot(bad)
    assert codes.deployed_release("problem_type_1") == "v000"
    with pytest.raises(ValueError):
        codes.deployed_release("nothing")


def test_model_id(spark):
    row = spark.range(1).select(
        codes.model_id(F.lit("problem_type_0"), F.lit("2020/2021"), F.lit("NWAC.1128")), codes.deployment_alias(F.lit("v001"))
    ).first()
    assert tuple(row) == ("problem_type_0.2020-2021.NWAC.1128", "v001-deployment")
