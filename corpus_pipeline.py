"""The training-text pipeline: five stages over the documents table, each on what its predecessor kept."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from firnspark.llm.decontaminate import contaminated
from firnspark.llm.near_dup import near_duplicates
from firnspark.llm.packing import pack
from firnspark.llm.suffix_dedup import without_repeats
from firnspark.llm.toxicity import toxicity
from firnspark.operators.lookup import lookup_join
from firnspark.session import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Rows of a file, as bits of a row's number.
PLACE_BITS = 36


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with a number of their own for every row: that of its file, and its place there.  It
    stays the same however often the files are read.  Documents from elsewhere are written first."""
    try:
        placed = docs.select(*COLUMNS, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    except AnalysisException:
        docs = materialise(docs.select(*COLUMNS), "rows")
        placed = docs.select(*COLUMNS, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    files = materialise(placed.select("file").distinct(), "row-files")
    number = Window.orderBy("file")
    # One row a file; the driver knows them all when it plans a scan.
    files = materialise(files.withColumn("row", (F.row_number().over(number) - 1).cast("long") * (1 << PLACE_BITS)), "row-files")
    return lookup_join(placed, files, ["file"], row_bytes=1024).select(*COLUMNS, (F.col("row") + F.col("place")).alias("row"))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The keyed documents whose row is not in ``gone``."""
    gone = materialise(gone.distinct(), "rows-gone")
    return lookup_join(docs, gone, ["row"], "left_anti", row_bytes=64).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored as toxic go, whatever their id."""
    labels, docs = spark.read.parquet(f"{sf_dir}/labels.parquet"), _keyed(docs)
    return _without(docs, toxicity(docs, labels, row_column="row").where("predicted = 1").select("row"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: that with the smallest id, then the first; a null id comes last."""
    docs = _keyed(docs)
    groups = materialise(near_duplicates(docs, id_column="row").select("row", "component_id"), "row-groups")
    # Only groups of several rows are looked at; a row alone is never in question.
    often = groups.groupBy("component_id").count().where("count > 1").select("component_id")
    member = groups.join(often, "component_id").join(docs.select("row", "doc_id"), "row")
    member = materialise(member.selectExpr("component_id", "struct(doc_id is null as unnamed, doc_id, row) as place"), "row-members")
    first = member.groupBy("component_id").agg(F.min("place").alias("first"))
    gone = member.join(first, "component_id").where("place.row <> first.row").selectExpr("place.row as row")
    return _without(docs, gone)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 200 and more that occur elsewhere too are cut out of the texts; every document stays."""
    kept = without_repeats(docs, keep=("text", "lang", "source", "n_chars"))
    cut = F.col("n_removed") > 0
    return kept.select(
        "doc_id",
        F.when(cut, F.col("kept_text")).otherwise(F.col("text")).alias("text"),
        "lang",
        "source",
        F.when(cut, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go, whatever their id."""
    benchmark, docs = spark.read.parquet(f"{sf_dir}/benchmark.parquet"), _keyed(docs)
    return _without(docs, contaminated(docs, benchmark, id_column="row").select("row"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with the bin each is packed into."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", remove_repeats),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack_sequences),
]
# Language models, suffix arrays and edit distances are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
