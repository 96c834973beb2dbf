"""Versioned model registry as three append-only tables below one path, payloads by season."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from firnspark.functions import calendar as cal
from firnspark.functions import codes
from firnspark.operators.lookup import within
from firnspark.operators.training import GROUP, SLOT_COMPONENTS
from firnspark.session import materialise
from firnspark.sources.storage import read_table

ID = ["model_name", *GROUP]
# Input columns of every model, kept with it as a parameter.
MODEL_INPUTS = {"problem_type_0": "problem_type_0"}
MODEL_INPUTS |= {name: ",".join(codes.PROBLEM_MODELS) for name in codes.PROBLEM_MODELS[1:]}
MODEL_INPUTS |= {name: f"problem_type,{','.join(SLOT_COMPONENTS)}" for name in codes.ASPECT_MODELS}
PAYLOAD_KEY = ["model_id", "version", "registration"]


def deployments(spark: SparkSession) -> DataFrame:
    """The configured release of every model."""
    return spark.createDataFrame(sorted(codes.DEPLOYMENTS.items()), "model_name string, release string")


def next_versions(new: DataFrame, registered: DataFrame | None) -> DataFrame:
    """Number new models one above the highest registered version of their id."""
    if registered is None:
        return new.withColumn("version", F.lit(1).cast("long"))
    highest = registered.groupBy("model_id").agg(F.max("version").alias("_highest"))
    return (
        new.join(highest, "model_id", "left")
        .withColumn("version", (F.coalesce("_highest", F.lit(0)) + 1).cast("long"))
        .drop("_highest")
    )


def latest_versions(registered: DataFrame) -> DataFrame:
    """The newest version behind every (model id, release) alias."""
    newest = registered.groupBy("model_id", "release").agg(F.max("version").alias("version"))
    return registered.join(newest, ["model_id", "release", "version"], "left_semi")


def describe_models(groups: DataFrame, names: dict[str, str]) -> DataFrame:
    """Registry rows for every model of ``names`` (name -> release) in every trained group."""
    pairs = F.array(*[F.struct(F.lit(n).alias("model_name"), F.lit(r).alias("release")) for n, r in names.items()])
    season = cal.season_label(F.col("model_year"))
    rows = groups.select(*groups.columns, F.explode(pairs).alias("model")).select(*groups.columns, "model.*")
    return rows.withColumns(
        {
            "avalanche_season": season,
            "model_id": codes.model_id(F.col("model_name"), season, F.col("region_id")),
            "alias": codes.deployment_alias(F.col("release")),
        }
    )


def majority_payload(majority: DataFrame) -> DataFrame:
    name = F.concat(F.lit("problem_type_"), F.col("slot").cast("string"))
    return majority.withColumn("model_name", name).drop("slot")


def linear_payload(linear: DataFrame) -> DataFrame:
    """One row per aspect model with its own weights."""
    pairs = ", ".join(f"concat('{name}_', slot), weights[{target}]" for target, name in enumerate(SLOT_COMPONENTS))
    stacked = f"stack({len(SLOT_COMPONENTS)}, {pairs}) AS (model_name, weights)"
    return linear.selectExpr(*GROUP, "n", "rank", stacked)


@dataclass(frozen=True)
class Registry:
    """Reads and writes below ``path``: models, classes and weights."""

    spark: SparkSession
    path: str

    def _table(self, name: str) -> str:
        return f"{self.path}/{name}"

    def models(self) -> DataFrame | None:
        return read_table(self.spark, self._table("models"))

    def register(
        self,
        majority: DataFrame,
        linear: DataFrame,
        run_id: str,
        metrics: DataFrame | None = None,
        aspect_release: str = "v001",
        created: Column | None = None,
    ) -> None:
        """Append a new version of all trained models.

        ``metrics`` has one row per model (model_name, region_id, model_year) with a map
        of metric values.  Payload is written before the model rows that point to it by
        a fresh registration id, so an interrupted run leaves neither a model without
        payload nor payload that a second attempt would double.
        """
        problem = describe_models(
            majority.select(*GROUP).distinct(), {n: codes.deployed_release(n) for n in codes.PROBLEM_MODELS}
        )
        aspects = describe_models(linear.select(*GROUP).distinct(), {n: aspect_release for n in codes.ASPECT_MODELS})
        inputs = codes.literal_lookup(MODEL_INPUTS, F.col("model_name"))
        new = self._numbered(problem.unionByName(aspects), inputs, run_id, metrics, created)
        version = new.select(*ID, "model_id", "version", "registration")
        classes = majority_payload(majority).join(version, ID)
        weights = linear_payload(linear).join(version, ID)
        classes.write.mode("append").partitionBy("model_year").parquet(self._table("classes"))
        weights.write.mode("append").partitionBy("model_year").parquet(self._table("weights"))
        new.write.mode("append").parquet(self._table("models"))

    def _numbered(
        self, described: DataFrame, inputs: Column, run_id: str, metrics: DataFrame | None, created: Column | None
    ) -> DataFrame:
        """Rows of new models with their versions, under a fresh registration id."""
        new = next_versions(described, self.models())
        if metrics is not None:
            new = new.join(metrics, ID, "left")
        else:
            new = new.withColumn("metrics", F.lit(None).cast("map<string,double>"))
        return materialise(
            new.withColumns(
                {
                    "params": F.create_map(F.lit("inputs"), inputs),
                    "run_id": F.lit(run_id),
                    "created": F.current_timestamp() if created is None else created,
                    "registration": F.lit(uuid.uuid4().hex),
                }
            )
        )

    def register_payloads(
        self,
        fitted: DataFrame,
        model_name: str,
        release: str,
        inputs: str,
        run_id: str,
        metrics: DataFrame | None = None,
        created: Column | None = None,
    ) -> None:
        """Append a new version of (region_id, model_year, n, payload) models whose payload is bytes."""
        fitted = materialise(fitted)
        described = describe_models(fitted.select(*GROUP), {model_name: release})
        new = self._numbered(described, F.lit(inputs), run_id, metrics, created)
        payloads = fitted.join(new.select(*ID, "model_id", "version", "registration"), GROUP)
        payloads.write.mode("append").partitionBy("model_year").parquet(self._table("payloads"))
        new.write.mode("append").parquet(self._table("models"))

    def load_payloads(self, deployed: DataFrame, model_name: str) -> DataFrame:
        """(region_id, model_year, n, payload) of the deployed versions of a model."""
        return self._payload("payloads", deployed.where(F.col("model_name") == model_name)).select(*GROUP, "n", "payload")

    def deployed(self, years: tuple[int, int] | None = None, releases: dict[str, str] | None = None) -> DataFrame:
        """Newest version of every model at its configured release, of all seasons or from the
        first to the last of ``years``; ``releases`` adds models to the configured ones."""
        models = self.models()
        if models is None:
            raise LookupError(f"no models are registered below {self.path}")
        wanted = codes.literal_lookup(codes.DEPLOYMENTS | (releases or {}), F.col("model_name"))
        if years is not None:
            models = models.where(F.col("model_year").between(*years))
        return latest_versions(models).where(F.col("release") == wanted)

    def _payload(self, name: str, deployed: DataFrame | None) -> DataFrame:
        """Stored rows of the deployed models, read from the folders of their seasons only."""
        wanted = materialise((self.deployed() if deployed is None else deployed).select("model_year", *PAYLOAD_KEY))
        return within(self.spark.read.parquet(self._table(name)), wanted, ["model_year", *PAYLOAD_KEY], 256)

    def load_majority(self, deployed: DataFrame | None = None) -> DataFrame:
        slot = F.substring_index("model_name", "_", -1).cast("int")
        return self._payload("classes", deployed).select(
            *GROUP, slot.alias("slot"), "level", "k0", "k1", "k2", "ranked", "n_rows"
        )

    def load_linear(self, deployed: DataFrame | None = None) -> DataFrame:
        """Weights of the deployed aspect models, nine per region, season and slot."""
        weights = self._payload("weights", deployed)
        slot = F.substring_index("model_name", "_", -1).cast("int")
        per_model = weights.withColumn("slot", slot)
        rows = [
            F.expr(f"first(CASE WHEN model_name = concat('{name}_', slot) THEN weights END, true)")
            for name in SLOT_COMPONENTS
        ]
        return per_model.groupBy(*GROUP, "slot").agg(
            F.first("n").alias("n"), F.first("rank").alias("rank"), F.array(*rows).alias("weights")
        )

    def versions(self) -> DataFrame:
        return self.deployed().select(*ID, "version")


