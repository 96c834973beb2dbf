"""URL rules looked up in a sorted digest array.

A rule is a host and a path prefix with a verdict; it fits its host and all subdomains.  The
rules become one array of 64-bit xxhash keys in ascending order, beside the full strings.  A
task maps that array from a file of its own, forms for each url the keys that could fit (every
suffix of the host with every prefix of the path that has the length of some rule's path),
probes all of them at once by vectorised binary search, and compares the stored string wherever
the key is equal, so a collision never decides.

The index is handed out only while the rules take at most ``INDEX_BYTES``; a larger list is
joined by Spark on the same keys, with the same comparison.

A null url, or one without ``://``, has an empty host and path and fits no rule.  The longest
rule wins, of equally long ones that with the longer host, and of equal ones the smaller verdict.
Rules with a null are ignored.  Without rules every url gets the default.  Repeated rows are
judged each for itself.  Very long urls only have more keys.  Extra columns are ignored.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from firnspark.llm.common import batches

INDEX_BYTES = 64 << 20
# The rules asked for, as host and path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


class DigestIndex:
    """Sorted keys, the strings behind them and their verdicts, mapped from a file."""

    def __init__(self, packed: bytes) -> None:
        count = int(np.frombuffer(packed, np.int64, 1)[0])
        self.file = tempfile.TemporaryFile()
        self.file.write(packed)
        self.file.flush()
        at = 8
        self.keys = np.memmap(self.file, np.uint64, "r", at, (count,)) if count else np.zeros(0, np.uint64)
        at += 8 * count
        self.offsets = np.memmap(self.file, np.int64, "r", at, (count + 1,))
        self.text = np.memmap(self.file, np.uint8, "r", at + 8 * (count + 1))

    def entry(self, i: int) -> tuple[str, str, str]:
        """Host, path and verdict of a rule."""
        host, path, verdict = bytes(self.text[self.offsets[i] : self.offsets[i + 1]]).decode().split("\0")
        return host, path, verdict

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (probe, entry) numbers with equal keys."""
        first = np.searchsorted(self.keys, keys, side="left")
        last = np.searchsorted(self.keys, keys, side="right")
        probe = np.repeat(np.arange(len(keys)), last - first)
        step = np.arange(len(probe)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)
        return probe, np.repeat(first, last - first) + step


def key_of(host: str, path: str) -> int:
    return xxhash.xxh64_intdigest(f"{host}\0{path}")


def packed_index(rules: list[tuple[str, str, str]]) -> bytes:
    """The file of a digest index over (verdict, host, path) rules."""
    best: dict[tuple[str, str], str] = {}
    for verdict, host, path in rules:
        best[host, path] = min(verdict, best.get((host, path), verdict))
    entries = sorted((key_of(*place), "\0".join((*place, verdict)).encode()) for place, verdict in best.items())
    keys = np.array([k for k, _ in entries], np.uint64)
    offsets = np.cumsum([0, *(len(t) for _, t in entries)]).astype(np.int64)
    # One byte more, as an empty file range cannot be mapped.
    return np.int64(len(entries)).tobytes() + keys.tobytes() + offsets.tobytes() + b"".join(t for _, t in entries) + b"\0"


def suffixes(host: str) -> list[str]:
    """The host and all its parent domains."""
    out = [host] if host else []
    while "." in host:
        host = host.split(".", 1)[1]
        out.append(host)
    return [h for h in out if h]


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = "allow",
    limit: int = INDEX_BYTES,
) -> DataFrame:
    """One row per page: id, host, path, rule (host and path of the rule that decides, or null) and
    verdict.  ``rules`` has columns verdict, host and path."""
    spark = pages.sparkSession
    url = F.col(url_column)
    urls = pages.select(F.col(id_column).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rules = rules.select("verdict", "host", "path").dropna()
    size = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path") + F.octet_length("verdict") + 24)).first()[0]
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())
    if (size or 0) > limit:
        return _joined(urls, rules, lengths, default).withColumnRenamed("id", id_column)
    packed = packed_index([(r["verdict"], r["host"], r["path"]) for r in rules.collect()])
    sent = spark.sparkContext.broadcast(packed)

    def rows(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestIndex(sent.value)
        for batch in batches(table):
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            owner, probes = [], []
            for row, (host, path) in enumerate(zip(hosts, paths, strict=True)):
                for domain in suffixes(host):
                    for length in lengths:
                        if length <= len(path):
                            owner.append(row)
                            probes.append((domain, path[:length]))
            keys = np.fromiter((key_of(*p) for p in probes), np.uint64, len(probes))
            best: dict[int, tuple] = {}
            for probe, entry in zip(*index.find(keys), strict=True):
                host, path, verdict = index.entry(entry)
                if (host, path) == probes[probe]:
                    found = (len(host) + len(path), len(host), host + path, verdict)
                    best[owner[probe]] = max(best.get(owner[probe], found), found)
            decided = [best.get(row) for row in range(len(hosts))]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([d and d[2] for d in decided], pa.string()),
                    pa.array([d[3] if d else default for d in decided], pa.string()),
                ],
                ["id", "host", "path", "rule", "verdict"],
            )

    kind = urls.schema["id"].dataType.simpleString()
    judged = urls.mapInArrow(rows, f"id {kind}, host string, path string, rule string, verdict string")
    return judged.withColumnRenamed("id", id_column)


def _joined(urls: DataFrame, rules: DataFrame, lengths: list[int], default: str) -> DataFrame:
    """The same by an equi-join on the keys, for rule lists too large to hand out."""
    domains = "transform(sequence(0, size(split(host, '[.]')) - 1), i -> array_join(slice(split(host, '[.]'), i + 1, 999999), '.'))"
    heads = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    places = urls.select("host", "path").distinct().withColumn("domain", F.explode(F.expr(domains))).withColumn("head", F.explode(heads))
    places = places.withColumn("start", F.expr("substring(path, 1, head)")).withColumn("key", F.xxhash64("domain", "start"))
    keyed = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    keyed = keyed.select(F.xxhash64("host", "path").alias("key"), F.col("host").alias("r_host"), F.col("path").alias("r_path"), "verdict")
    hits = places.join(keyed, "key").where("domain = r_host and start = r_path")
    order = F.struct((F.length("r_host") + F.length("r_path")).alias("n"), F.length("r_host").alias("h"))
    found = hits.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), "verdict"), order).alias("best"))
    return urls.join(found, ["host", "path"], "left").select(
        "id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
