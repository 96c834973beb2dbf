import duckdb
import pytest
from pyspark.sql import functions as F

from firnspark.functions import aspects
from firnspark.plans.oracles import STEPS

GOLDEN = [
    (255, 0.0, 0.0, 1.0),
    (0, 0.0, 0.0, 0.0),
    (8, 0.707106781187, -0.707106781187, 0.125),
    (28, 0.707106781187, -0.707106781187, 0.375),
    (60, 0.382683432365, -0.923879532511, 0.5),
    (195, -0.382683432365, 0.923879532511, 0.5),
    (57, 0.0, -1.0, 0.375),
    (187, 0.0, 1.0, 0.375),
    (17, 0.0, 1.0, 0.125),
    (129, -0.382683432365, 0.923879532511, 0.25),
]


@pytest.mark.parametrize("mask, sin, cos, extent", GOLDEN)
def test_golden_masks(mask, sin, cos, extent):
    table = aspects.component_table()
    assert (table["sin"][mask], table["cos"][mask], table["range"][mask]) == (sin, cos, extent)


def test_all_masks_agree_with_arc_search():
    expected = {m: (s, c, r) for m, s, c, r in duckdb.sql(STEPS["geometry"]).fetchall()}
    table = aspects.component_table()
    assert {m: (table["sin"][m], table["cos"][m], table["range"][m]) for m in range(256)} == expected


def test_components_of_flag_columns(spark):
    flags = spark.range(256).selectExpr("id", *[f"shiftright(id, {i}) & 1 AS {a}" for i, a in enumerate(aspects.ASPECTS)])
    parts = aspects.aspect_components(list(aspects.ASPECTS))
    rows = flags.select("id", *[c.alias(n) for n, c in parts.items()]).collect()
    table = aspects.component_table()
    assert all((r["sin"], r["cos"], r["range"]) == tuple(table[n][r["id"]] for n in aspects.COMPONENTS) for r in rows)


def test_missing_flags_count_as_unset(spark):
    row = spark.range(1).select(
        aspects.flag(F.lit(None).cast("double")).alias("a"),
        aspects.flag(F.lit(float("nan"))).alias("b"),
        aspects.flag(F.lit(3)).alias("c"),
    ).first()
    assert tuple(row) == (0, 0, 1)


def test_packed_flags_round_trip(spark):
    names = [f"{a}_{e}_0" for a in aspects.ASPECTS for e in aspects.ELEVATIONS]
    wide = spark.range(500).selectExpr(*[f"cast(pmod(xxhash64(id, '{n}'), 2) AS bigint) AS {n}" for n in names])
    packed = wide.withColumn("_bits_0", aspects.slot_bits(0))
    back = [
        f"{aspects.flag_of_bits_sql(0, a, e)} = {a}_{e}_0" for a in aspects.ASPECTS for e in aspects.ELEVATIONS
    ]
    assert packed.where(" AND ".join(back)).count() == 500
