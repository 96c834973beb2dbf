"""Partitioned tables on shared storage."""

from __future__ import annotations

import contextlib

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from firnspark.operators.lookup import lookup_join, within
from firnspark.session import materialise


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The store and the path within it of a folder or file as Spark names it."""
    scheme, mark, rest = path.partition("://")
    # Spark's names of object stores, and those the store library knows.
    own = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(f"{own}{mark}{rest}" if mark else path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The stored table, or None when nothing was written yet."""
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_partitions(df: DataFrame, path: str, folders: list[str]) -> None:
    """Overwrite the folders present in ``df``.

    The rebalance hint sends a folder to few tasks, and lets AQE split one that is large.
    """
    (
        df.hint("rebalance", *folders)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .parquet(path)
    )


def _drop_folders(folders: DataFrame) -> None:
    """Delete the folders of a one-column frame, in parallel."""

    def drop(rows) -> None:
        for row in rows:
            store, path = open_store(row["folder"])
            # A repeated task may find its folders gone.
            with contextlib.suppress(FileNotFoundError):
                store.delete_dir(path)

    folders.foreachPartition(drop)


def replace_partitions(
    df: DataFrame,
    path: str,
    requested: DataFrame,
    keys: list[str],
    folders: list[str],
    materialised: bool = False,
) -> None:
    """Delete the rows of the requested keys, then insert ``df``.

    ``folders`` are the columns the table is laid out by and a subset of ``keys``; a
    folder may hold keys that were not requested, and those rows are kept.  Only touched
    folders are read and written.  A requested key without new rows still loses its old
    rows, which a dynamic overwrite alone would leave in place.  ``materialised`` says
    that ``df`` is cheap to read more than once.
    """
    spark = df.sparkSession
    stored = read_table(spark, path, df.schema)
    if stored is None:
        # Read once, so no copy is needed.
        write_partitions(df, path, folders)
        return
    incoming = df if materialised else materialise(df)
    requested = materialise(requested.select(*keys).distinct())
    touched = materialise(requested.select(*folders).unionByName(incoming.select(*folders)).distinct())
    # The copy keeps the surviving rows safe while their folders are being replaced.
    whole = set(keys) == set(folders)
    # Of folders that are replaced as a whole, no row is read.
    read = materialise(touched.join(requested, folders, "left_anti")) if whole else touched
    old = within(stored, read, folders)
    survivors = materialise((old if whole else lookup_join(old, requested, keys, "left_anti", 96)).select(*df.columns))
    result = incoming.unionByName(survivors)
    folder_path = F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]+$", 1)
    present = within(stored.select(*folders, folder_path.alias("folder")), touched, folders).distinct()
    emptied = materialise(present.join(result.select(*folders).distinct(), folders, "left_anti").select("folder"))
    write_partitions(result, path, folders)
    _drop_folders(emptied)
    spark.catalog.refreshByPath(path)
