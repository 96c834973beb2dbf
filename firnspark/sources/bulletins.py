"""Landed bulletin documents: schemas, scans and the JSON sink."""

from __future__ import annotations

import itertools
import uuid
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from firnspark.session import materialise, scratch_path
from firnspark.sources.arrays import MEMBER, packed, scan_arrays, unpacked
from firnspark.sources.storage import open_store

_text = T.StringType()
# Bytes written at once to an array file, how many tasks do so, and text a task holds before that.
COPIED = 1 << 20
LANDING_TASKS = 1000
HELD_BYTES = 64 << 20


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# Numbers that some bulletins quote are read as text and cast later.
CAIC_DOCUMENT = _struct(
    type=_text,
    expiryDateTime=_text,
    issueDateTime=_text,
    areaId=_text,
    title=_text,
    polygons=T.ArrayType(_text),
    avalancheSummary=_struct(days=T.ArrayType(_struct(content=_text))),
    dangerRatings=_struct(days=T.ArrayType(_struct(alp=_text, tln=_text, btl=_text))),
    avalancheProblems=_struct(
        days=T.ArrayType(
            T.ArrayType(
                _struct(
                    type=_text,
                    likelihood=_text,
                    expectedSize=_struct(min=_text, max=_text),
                    aspectElevations=T.ArrayType(_text),
                )
            )
        )
    ),
)
NWAC_DOCUMENT = _struct(
    product_type=_text,
    published_time=_text,
    updated_at=_text,
    bottom_line=_text,
    hazard_discussion=_text,
    danger=T.ArrayType(_struct(valid_day=_text, upper=T.LongType(), middle=T.LongType(), lower=T.LongType())),
    forecast_avalanche_problems=T.ArrayType(
        _struct(
            rank=T.LongType(),
            avalanche_problem_id=T.LongType(),
            likelihood=_text,
            size=T.ArrayType(_text),
            location=T.ArrayType(_text),
        )
    ),
    forecast_zone=T.ArrayType(_struct(id=_text, name=_text, zone_id=_text)),
)
DOCUMENTS = {"CAIC": CAIC_DOCUMENT, "NWAC": NWAC_DOCUMENT}
CORRUPT = "_corrupt_record"


def document_schema(center: str) -> T.StructType:
    try:
        return DOCUMENTS[center]
    except KeyError:
        raise ValueError(f"unsupported forecast center {center!r}") from None


def read_schema(center: str) -> T.StructType:
    return T.StructType(document_schema(center).fields + [T.StructField(CORRUPT, _text, True)])


def landed_day(path: str = "_metadata.file_path") -> Column:
    """Partition day of a landed file: ``<day>.json``, also ``.gz``, or a ``distribution_date=<day>`` folder; else null."""
    stem = F.regexp_extract(path, r"(?:^|/)(\d{4}-\d{2}-\d{2})\.json(?:\.gz)?$", 1)
    folder = F.regexp_extract(path, r"distribution_date=(\d{4}-\d{2}-\d{2})", 1)
    named = F.coalesce(F.nullif(stem, F.lit("")), F.nullif(folder, F.lit("")))
    return named.try_cast("date")


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, modified, length, landed_date) of every file below ``path``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("modificationTime").alias("modified"), "length", landed_day("path").alias("landed_date"))


def scan_documents(
    spark: SparkSession, center: str, path: str | list[str], lines: bool = False, split_bytes: int | None = None
) -> DataFrame:
    """One row per bulletin of every landed file.

    A file holds one JSON array, as the services deliver it, or with ``lines`` one
    document per line, as ``land_documents`` writes it.  An array is one task, unless
    ``split_bytes`` lets ranges of that size be read independently (``arrays.scan_arrays``);
    then an element that cannot be parsed is refused alone and not with its file.
    """
    if split_bytes is not None:
        if lines:
            raise ValueError("files of lines are split without split_bytes")
        return parse_elements(scan_arrays(spark, path, split_bytes), center)
    return (
        spark.read.schema(read_schema(center))
        .option("multiLine", not lines)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
        .json(path)
        .withColumn("landed_date", landed_day())
    )


def once_parsed(parsed: Column) -> Column:
    """The fields of a parsed text as columns.

    A generator of one row: fields taken from a plain column would each parse the text again,
    as would every filter that is pushed below it.
    """
    return F.inline(F.array(parsed))


def parse_elements(found: DataFrame, center: str) -> DataFrame:
    """Bulletins of the (file, document) rows of array files, in the columns of ``scan_documents``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json("document", read_schema(center), options)
    days = found.select("document", landed_day("file").alias("landed_date"))
    return days.select(once_parsed(parsed), "landed_date")


def parse_documents(df: DataFrame, center: str, column: str = "document", keep: tuple[str, ...] = ()) -> DataFrame:
    """Bulletins held as JSON text in a table column."""
    return df.select(*keep, once_parsed(F.from_json(column, document_schema(center))))


def land_documents(df: DataFrame, path: str, day: str = "distribution_date") -> None:
    """Write documents as compressed JSON lines, replacing the days present in ``df``.

    The rebalance hint lets AQE split a day that holds much of the data, so every file is read by one task.
    """
    (
        df.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .partitionBy(day)
        .json(path)
    )


def land_arrays(df: DataFrame, path: str, day: str = "distribution_date", compressed: bool = False) -> None:
    """Write (day, document text) rows as the services deliver them: one JSON array per day in
    ``<day>.json``, replacing a file of that name; ``compressed`` into ``<day>.json.gz``, whose gzip members
    ``scan_arrays`` reads by ranges.

    Tasks write their rows where these are, each into one file of compressed blocks of a day, so no row is
    dealt out or sorted.  A day is one file and so one task, which copies its blocks into it one by one.
    """
    pieces = scratch_path(df.sparkSession, "pieces")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(pieces)
        store.create_dir(root, recursive=True)
        name, held, sizes, found = uuid.uuid4().hex, defaultdict(list), defaultdict(int), []
        with store.open_output_stream(f"{root}/{name}", buffer_size=COPIED) as out:

            def put(own: str) -> None:
                block = packed(b",".join(held.pop(own)))
                found.append({"day": own, "piece": name, "at": out.tell(), "size": len(block)})
                sizes.pop(own)
                out.write(block)

            for batch in batches:
                for own, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                    held[own].append(text.encode())
                    sizes[own] += len(text)
                    if sizes[own] >= MEMBER:
                        put(own)
                if sum(sizes.values()) >= HELD_BYTES:
                    for own in list(held):
                        put(own)
            for own in list(held):
                put(own)
        if found:
            yield pa.RecordBatch.from_pylist(found)

    def join(rows: Iterator[Row]) -> None:
        (store, root), (source, held) = open_store(path), open_store(pieces)
        store.create_dir(root, recursive=True)
        form = packed if compressed else bytes
        for own, blocks in rows:
            name = f"{root}/{own}.json{'.gz' if compressed else ''}"
            with store.open_output_stream(name, compression=None, buffer_size=COPIED) as out:
                out.write(form(b"["))
                between = b""
                for piece, group in itertools.groupby(blocks, key=lambda block: block.piece):
                    with source.open_input_file(f"{held}/{piece}") as part:
                        for block in group:
                            member = part.read_at(block.size, block.at)
                            out.write(between)
                            out.write(member if compressed else unpacked(member))
                            between = form(b",")
                out.write(form(b"]"))

    chosen = df.select(F.col(day).cast("string").alias("day"), "document").where("day is not null")
    parts = materialise(chosen.mapInArrow(write, "day string, piece string, at long, size long"), "pieces-of-days", True)
    own = F.sort_array(F.collect_list(F.struct("piece", "at", "size")))
    days = materialise(parts.groupBy("day").agg(own.alias("blocks")))
    days.repartitionByRange(max(1, min(days.count(), LANDING_TASKS)), "day").foreachPartition(join)
    store, root = open_store(pieces)
    if store.get_file_info(root).type == fs.FileType.Directory:
        store.delete_dir(root)


def corrupt_documents(documents: DataFrame) -> DataFrame:
    """Files the JSON reader could not parse, with their text."""
    return documents.where(F.col(CORRUPT).isNotNull())


def assemble_documents(index: DataFrame, documents: DataFrame, window_days: int = 1) -> DataFrame:
    """Documents each request day is served, from a landed index (id, listed_date) and
    a landed document table (id, document).

    A request for a day asks the index for the interval [day, day + ``window_days``], so
    an index entry serves every request day whose interval holds its date.  The result
    keeps one row per document: the array of a day is only a file layout, and collecting
    it would put a whole day into one row.
    """
    first = F.date_sub(F.col("listed_date"), window_days)
    requests = index.withColumn("request_date", F.explode(F.sequence(first, F.col("listed_date"))))
    return requests.join(documents, "id").select("request_date", "id", "document")
