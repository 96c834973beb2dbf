"""WARC archives: one gzip member per record, written and read back sequentially.

Records with equal payloads of at least ``LEAST_BYTES`` are stored once: the one with the
smallest id is the response, the others are revisits that refer to it and carry its payload's
length and digest.  Every task streams its records into archives of about ``ARCHIVE_BYTES`` in
the shared folder and reports them; only reported archives are read, so what a lost or repeated
task has left behind does no harm.

The reader takes an archive in blocks: it inflates one member after the other, cuts the record by
its content length, and checks the payload's digest.  A truncated member, a missing length,
bytes that do not add up or a wrong digest raise ``ValueError``.

A null payload is empty.  A null id is written without one, is always a response and is no one's
referent.  Rows that repeat the smallest id are all responses.  Line breaks and per cent signs in a url are escaped.
A very long payload is inflated in blocks and held once.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from firnspark.llm.common import batches
from firnspark.session import materialise, scratch_path
from firnspark.sources.storage import open_store

LEAST_BYTES = 100
ARCHIVE_BYTES = 64 << 20
BLOCK = 1 << 16
LEVEL = 5
# Rows of decoded records go on in groups of about this many payload bytes.
GROUP_BYTES = 8 << 20
DATE = "1970-01-01T00:00:00Z"
HEAD_END = b"\r\n\r\n"


def with_referents(pages: DataFrame, id_column: str, payload_column: str, least: int = LEAST_BYTES) -> DataFrame:
    """The pages as (id, url, payload, digest, refers_to); only the ids of copies are shuffled by digest."""
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit(b""))
    rows = pages.withColumn("payload", payload).withColumn("digest", F.sha2("payload", 256))
    thin = rows.where((F.octet_length("payload") >= least) & F.col(id_column).isNotNull())
    thin = materialise(thin.select(F.col(id_column).alias("id"), "digest"), "payload-digests")
    first = thin.groupBy("digest").agg(F.min("id").alias("refers_to"), F.max("id").alias("last"))
    first = materialise(first.where("refers_to < last").drop("last"), "payload-firsts")
    again = thin.distinct().join(first, "digest").where("id > refers_to")
    rows = rows.withColumn("id", F.col(id_column))
    return rows.join(again, ["id", "digest"], "left")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record."""
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Payload-Length": str(len(payload)),
    }
    if url is not None:
        head["WARC-Target-URI"] = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    block = payload
    if refers_to is not None:
        head["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        block = b""
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + HEAD_END


def write_archives(rows: DataFrame, folder: str, archive_bytes: int | None = None) -> DataFrame:
    """Write (id, url, payload, digest, refers_to) rows; the archives as (path, records)."""
    most = archive_bytes or ARCHIVE_BYTES

    def written(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        out, path, records = None, "", 0

        def report() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([records], pa.int64())})

        for batch in batches(table):
            columns = [batch.column(c) for c in ("id", "url", "payload", "digest", "refers_to")]
            for values in zip(*columns, strict=True):
                if out is None:
                    path, records = f"{root}/{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(path, compression=None)
                packer = zlib.compressobj(LEVEL, wbits=31)
                out.write(packer.compress(record(*(v.as_py() for v in values))) + packer.flush())
                records += 1
                if out.tell() >= most:
                    yield report()
                    out = None
        if out is not None:
            yield report()

    return rows.select("id", "url", "payload", "digest", "refers_to").mapInArrow(written, "path string, records bigint")


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive, read in blocks."""
    held = stream.read(BLOCK)
    while held:
        inflate, parts = zlib.decompressobj(wbits=31), []
        while not inflate.eof:
            if not held:
                raise ValueError("truncated member")
            try:
                parts.append(inflate.decompress(held))
            except zlib.error as error:
                raise ValueError(f"damaged member: {error}") from error
            held = inflate.unused_data if inflate.eof else stream.read(BLOCK)
        text = b"".join(parts)
        cut = text.find(HEAD_END)
        lines = text[:cut].decode().split("\r\n")
        if cut < 0 or not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        head = dict(line.split(": ", 1) for line in lines[1:])
        if "Content-Length" not in head:
            raise ValueError("no content length")
        block = text[cut + 4 : cut + 4 + int(head["Content-Length"])]
        if len(text) != cut + 8 + int(head["Content-Length"]) or text[-4:] != HEAD_END:
            raise ValueError("content length does not fit the record")
        yield head, block
        held = held or stream.read(BLOCK)


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read_archives(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of the reported archives: id, url, record_type, payload_bytes,
    payload_digest, refers_to and, for responses, the payload."""

    def read(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(folder)
        for batch in batches(table):
            for path, records in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                rows, size, seen = [], 0, 0
                with store.open_input_stream(path, compression=None) as stream:
                    for head, block in records_of(stream):
                        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                        own = head["WARC-Type"] == "response"
                        if own and hashlib.sha256(block).hexdigest() != digest:
                            raise ValueError(f"wrong payload digest in {path}")
                        url = head.get("WARC-Target-URI")
                        url = url and url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
                        length = int(head["WARC-Payload-Length"])
                        ids = _page(head["WARC-Record-ID"]), _page(head.get("WARC-Refers-To"))
                        rows.append((ids[0], url, head["WARC-Type"], length, digest, ids[1], block if own and payloads else None))
                        size, seen = size + len(block), seen + 1
                        if size >= GROUP_BYTES:
                            yield _batch(rows)
                            rows, size = [], 0
                if seen != records:
                    raise ValueError(f"{path} has {seen} records instead of {records}")
                if rows:
                    yield _batch(rows)

    # As many tasks as archives: a number given is left alone, however short the list of archives is.
    n = archives.count()
    place = Window.orderBy("path")
    one_each = archives.withColumn("place", F.row_number().over(place)).repartitionByRange(max(n, 1), "place").drop("place")
    return one_each.mapInArrow(
        read,
        "id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary",
    )


_FIELDS = [
    ("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, kind) for c, (_, kind) in zip(zip(*rows, strict=True), _FIELDS, strict=True)]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in _FIELDS])


def archived(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", payloads: bool = True) -> DataFrame:
    """Write the pages as archives below the shared folder and read them back."""
    pages = pages.select(
        F.col(id_column).cast("long").alias("page"), F.col(url_column).alias("url"), F.col(payload_column).alias("body")
    )
    folder = scratch_path(pages.sparkSession, "warc")
    archives = materialise(write_archives(with_referents(pages, "page", "body"), folder), "warc-list")
    return read_archives(archives, folder, payloads).withColumnRenamed("id", id_column)
