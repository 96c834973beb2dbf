import pytest

from firnspark import schema as S

SMALL = S.table(
    S.ColumnSpec("k", "long"),
    S.ColumnSpec("name", "string", "undefined"),
    S.ColumnSpec("size", "double", 0.0),
    S.ColumnSpec("note", "string", "x", nullable=True),
)


def test_widths():
    assert len(S.BULLETIN.names) == 112 and len(S.COMBINED.names) == 115
    assert len(S.FEATURES.names) == 142 and len(S.TARGETS.names) == 35 and len(S.PREDICTIONS.names) == 10


def test_conform_adds_drops_orders_and_fills(spark):
    df = spark.createDataFrame([(1, None, "n")], "size int, name string, extra string")
    fitted = S.conform(df, SMALL)
    assert fitted.columns == SMALL.names
    assert tuple(fitted.first()) == (None, "undefined", 1.0, None)
    assert dict(fitted.dtypes)["size"] == "double"


def test_composition_keeps_place_and_last_definition():
    both = SMALL + S.table(S.ColumnSpec("name", "string", "other"), S.ColumnSpec("z", "long"))
    assert both.names == ["k", "name", "size", "note", "z"]
    assert both.columns[1].default == "other"


def test_violations_and_required(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k bigint, name string")
    report = {r["column_name"]: r["null_rows"] for r in S.null_violations(df, SMALL).collect()}
    assert report == {"k": 1, "name": 0, "size": 2}
    with pytest.raises(Exception, match="null in required columns: k"):
        S.enforce_required(S.conform(df, SMALL), SMALL).collect()


def test_check_columns(spark):
    good = S.conform(spark.range(1).withColumnRenamed("id", "k"), SMALL)
    S.check_columns(good, SMALL)
    with pytest.raises(S.SchemaMismatch, match="undeclared column more"):
        S.check_columns(good.selectExpr("*", "1 AS more"), SMALL)
    S.check_columns(good.selectExpr("*", "1 AS more"), SMALL, strict=False)
    with pytest.raises(S.SchemaMismatch, match="missing column size"):
        S.check_columns(good.drop("size"), SMALL)
    with pytest.raises(S.SchemaMismatch, match="column k is string"):
        S.check_columns(good.withColumn("k", good.k.cast("string")), SMALL)
