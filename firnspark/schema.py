"""Declared table schemas, and the projection that makes a frame fit one."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from firnspark.functions.aspects import (
    ASPECTS,
    COMPONENT_COLUMNS,
    ELEVATIONS,
    SLOTS,
)

TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    kind: str
    default: Any = None
    nullable: bool = False

    @property
    def fills(self) -> bool:
        return not self.nullable and self.default is not None

    @property
    def required(self) -> bool:
        return not self.nullable and self.default is None


@dataclass(frozen=True)
class TableSchema:
    columns: tuple[ColumnSpec, ...] = field(default_factory=tuple)

    def __add__(self, other: "TableSchema") -> "TableSchema":
        """Compose schemas; a column defined twice keeps its place and its last definition."""
        merged = {spec.name: spec for spec in self.columns}
        merged.update({spec.name: spec for spec in other.columns})
        return TableSchema(tuple(merged.values()))

    @property
    def names(self) -> list[str]:
        return [spec.name for spec in self.columns]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(s.name, TYPES[s.kind], True) for s in self.columns])

    def missing_from(self, df: DataFrame) -> list[str]:
        present = set(df.columns)
        return [name for name in self.names if name not in present]

    def extra_in(self, df: DataFrame) -> list[str]:
        declared = set(self.names)
        return [name for name in df.columns if name not in declared]


def table(*columns: ColumnSpec) -> TableSchema:
    return TableSchema(tuple(columns))


def _fitted(spec: ColumnSpec, present: bool) -> str:
    kind = TYPES[spec.kind].simpleString()
    value = f"cast({f'`{spec.name}`' if present else 'NULL'} AS {kind})"
    if spec.kind == "timestamp":
        value = f"date_trunc('MILLISECOND', {value})"
    if spec.fills:
        default = f"'{spec.default}'" if spec.kind == "string" else str(spec.default)
        value = f"coalesce({value}, cast({default} AS {kind}))"
    return f"{value} AS `{spec.name}`"


def conform(df: DataFrame, schema: TableSchema, keep: tuple[str, ...] = ()) -> DataFrame:
    """Add missing columns, drop extra ones, order, cast, and fill declared defaults.

    Columns named in ``keep`` go along unchanged in front.
    """
    present = set(df.columns)
    fitted = [_fitted(spec, spec.name in present) for spec in schema.columns]
    return df.selectExpr(*[f"`{name}`" for name in keep], *fitted)


def missing_required(df: DataFrame, schema: TableSchema) -> Column:
    """Names of required columns that are null in a row, as an array."""
    checks = [F.when(F.col(s.name).isNull(), F.lit(s.name)) for s in schema.columns if s.required]
    return F.array_compact(F.array(*checks))


def null_violations(df: DataFrame, schema: TableSchema) -> DataFrame:
    """One row per non-nullable column: how many rows miss a value.  One pass over the data."""
    specs = [s for s in schema.columns if not s.nullable]
    present = set(df.columns)
    counts = df.agg(
        *[
            (F.count(F.when(F.col(s.name).isNull(), 1)) if s.name in present else F.count(F.lit(1))).alias(s.name)
            for s in specs
        ]
    )
    return counts.unpivot([], [s.name for s in specs], "column_name", "null_rows")


class SchemaMismatch(ValueError):
    pass


def check_columns(df: DataFrame, schema: TableSchema, strict: bool = True) -> DataFrame:
    """Raise unless ``df`` has the declared columns and types (and, if strict, no others)."""
    problems = [f"missing column {name}" for name in schema.missing_from(df)]
    if strict:
        problems += [f"undeclared column {name}" for name in schema.extra_in(df)]
    if len(set(df.columns)) != len(df.columns):
        problems.append("repeated column names")
    actual = {f.name: f.dataType for f in df.schema.fields}
    for spec in schema.columns:
        found = actual.get(spec.name)
        if found is not None and found != TYPES[spec.kind]:
            problems.append(f"column {spec.name} is {found.simpleString()}, declared {spec.kind}")
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df


def enforce_required(df: DataFrame, schema: TableSchema) -> DataFrame:
    """Fail the job when a required column is null in any row."""
    missing = missing_required(df, schema)
    message = F.concat(F.lit("null in required columns: "), F.array_join(missing, ", "))
    return df.where(F.when(F.size(missing) == 0, True).otherwise(F.raise_error(message).cast("boolean")))


# --- declared tables ---------------------------------------------------------------

BULLETIN_KEYS = table(
    ColumnSpec("publish_datetime", "timestamp"),
    ColumnSpec("region_id", "string"),
    ColumnSpec("forecast_center", "string"),
    ColumnSpec("analysis_datetime", "timestamp"),
    ColumnSpec("distribution_date", "date"),
    ColumnSpec("forecast_date", "date"),
    ColumnSpec("forecast_days_out", "long"),
    ColumnSpec("forecast_date_season_day_number", "long"),
    ColumnSpec("avalanche_season", "string"),
    ColumnSpec("area_name", "string", "undefined"),
    ColumnSpec("area_id", "string"),
    ColumnSpec("polygons", "string"),
    ColumnSpec("avalanche_summary", "string", ""),
)


def slot_columns(slot: int) -> list[str]:
    """The 24 flags of a slot."""
    return [f"{aspect}_{elevation}_{slot}" for aspect in ASPECTS for elevation in ELEVATIONS]


def _slot_schema(slot: int) -> TableSchema:
    return table(
        ColumnSpec(f"problem_type_{slot}", "long", 0),
        ColumnSpec(f"likelihood_{slot}", "long", 0),
        ColumnSpec(f"min_size_{slot}", "double", 0.0),
        ColumnSpec(f"max_size_{slot}", "double", 0.0),
        *[ColumnSpec(name, "long", 0) for name in slot_columns(slot)],
        ColumnSpec(f"prevalence_{slot}", "long", 0),
        *[ColumnSpec(f"{elevation}_prevalence_{slot}", "long", 0) for elevation in ELEVATIONS],
    )


BULLETIN = BULLETIN_KEYS + table(*[ColumnSpec(f"danger_{e}", "long", 0) for e in ELEVATIONS])
for _slot in SLOTS:
    BULLETIN = BULLETIN + _slot_schema(_slot)

RUN = table(
    ColumnSpec("run_id", "string"),
    ColumnSpec("run_key", "string"),
    ColumnSpec("creation_datetime", "timestamp"),
)
ROW_KEY = table(ColumnSpec("forecast_date", "date"), ColumnSpec("region_id", "string"))
ASPECT_COMPONENTS = table(*[ColumnSpec(name, "double", 0.0) for name in COMPONENT_COLUMNS])

COMBINED = BULLETIN + RUN
FEATURES = RUN + ROW_KEY + BULLETIN + ASPECT_COMPONENTS
TARGETS = RUN + ROW_KEY + ASPECT_COMPONENTS + table(*[ColumnSpec(f"problem_type_{k}", "long") for k in SLOTS])
PREDICTIONS = (
    RUN
    + ROW_KEY
    + table(
        ColumnSpec("analysis_date", "date"),
        ColumnSpec("avalanche_season", "string"),
        ColumnSpec("forecast", "double"),
        ColumnSpec("release", "string"),
        ColumnSpec("mlflow_model_uri", "string"),
    )
)
EVALUATION = table(ColumnSpec("y_test", "double"), ColumnSpec("y_pred", "double"))


def stamp(df: DataFrame, run_id: str, run_key: Column, created: Column | None = None) -> DataFrame:
    """Add the run columns every stored table carries; one creation time per query."""
    return df.withColumns(
        {
            "run_id": F.lit(run_id),
            "run_key": run_key,
            "creation_datetime": F.current_timestamp() if created is None else created,
        }
    )
