import hashlib
import io
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnspark.llm import sharding, url_filter, warc
from firnspark.llm.sharding import balanced_shards
from firnspark.llm.url_filter import DigestIndex, judge, key_of, packed_index
from firnspark.session import materialise, scratch_path
from tests.llm.cases import awkward, awkward_rows, documents, no_rows, words


def check_law(rows):
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r.slot)
        assert 0 <= r.shard < 24 and r.law == "rows" and r.grown_shard is None
    counts = [len(shards[s]) for s in range(24)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())


def test_rows_law_and_groups(spark):
    rows = [(i, words(i % 700 if i % 3 else 10_000 + i, 6)) for i in range(2400)]
    got = balanced_shards(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_law(got)
    text = dict(rows)
    groups = defaultdict(Counter)
    for r in got:
        raw = text[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        groups[raw][r.shard] += 1
    linked = [g for g in groups.values() if sum(g.values()) > 1]
    together = sum(max(g.values()) for g in linked) / sum(sum(g.values()) for g in linked)
    assert together > 0.85


def test_group_larger_than_a_shard(spark):
    rows = [(i, "the same" if i % 3 == 0 else words(i, 5)) for i in range(600)]
    check_law(balanced_shards(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_sharding_takes_awkward_rows(spark):
    rows = balanced_shards(awkward(spark)).collect()
    check_law(rows)
    assert len(rows) == len(awkward_rows()) and {r.size for r in rows if r.doc_id in (1, 2)} == {8}
    assert balanced_shards(no_rows(spark)).collect() == []
    check_law(balanced_shards(documents(spark)).collect())


def test_quotas_swap_evenly():
    wanted = np.array([[0, 10, 0], [4, 0, 0], [0, 6, 0]], float)
    share = sharding.quotas(wanted, np.array([50.0, 50.0, 50.0]), 50)
    assert np.allclose(wanted * share, [[0, 4, 0], [4, 0, 0], [0, 0, 0]])


RULES = [("allow", "com", "/"), ("block", "a.com", "/x/"), ("allow", "b.a.com", "/x/"), ("block", "net", ""), ("block", "é.org", "/ü")]
URLS = [
    "http://a.com/x/1", "https://c.a.com/x/", "https://B.A.COM/x/y?q=/z", "http://a.com", "http://a.com/", "http://xa.com/x/",
    "net", None, "", "ftp://q.net", "http://q.net?x", "http://q.net#/x", "http://é.org/ü/1", "//a.com/x/", "http:///x/", "http://com/",
    "http://a.com/X/", "x://y://a.com/x/", "http://a..com/x/", "http://" + "s." * 500 + "a.com/x/" + "p" * 5000,
]


def expected(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host, path = rest[:cut].translate(str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})), rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] + [len(path)])]
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("limit", [url_filter.INDEX_BYTES, -1])
def test_urls_against_every_rule(spark, limit):
    pages = spark.createDataFrame([*enumerate(URLS), (0, URLS[0])], "page_id long, url string")
    rules = spark.createDataFrame([*RULES, ("block", None, "/")], "verdict string, host string, path string")
    rows = judge(pages, rules, limit=limit).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == expected(URLS[r.page_id])
    none = rules.where("false")
    assert {(r.rule, r.verdict) for r in judge(pages, none, limit=limit).collect()} == {(None, "allow")}
    assert judge(pages.where("false"), rules, limit=limit).collect() == []


def test_equal_keys_do_not_decide(monkeypatch):
    monkeypatch.setattr(url_filter, "key_of", lambda host, path: 7)
    index = DigestIndex(packed_index([("block", "a", "/"), ("allow", "b", "/")]))
    probe, entry = index.find(np.array([7, 8], np.uint64))
    assert list(probe) == [0, 0] and [index.entry(i)[0] for i in entry] == ["a", "b"]
    assert key_of("a", "b") != key_of("ab", "")


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    body = words(1, 60)
    pages = [
        (5, "http://a/?%0A%20", body), (11, "http://a/?x=%250A%25%250D", "z"), (3, "http://b\r\nX: y", body), (9, None, body), (1, "u", "short"), (2, "u", "short"), (4, "u", None),
        (6, "u", ""), (7, "ü", "é" * 300), (8, "u", "WARC/1.1\r\n\r\n" * 30), (None, "n", body), (3, "again", body), (10, "u", words(2, 30_000)),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' digest", "'y' payload", "'z' id")
    rows = warc.archived(df).collect()
    want = []
    for i, url, html in pages:
        raw = (html or "").encode()
        revisit = html == body and i in (5, 9)
        want.append((i, url, "revisit" if revisit else "response", len(raw), hashlib.sha256(raw).hexdigest(), 3 if revisit else None, None if revisit else raw))
    got = [(r.page_id, r.url, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to, r.payload and bytes(r.payload)) for r in rows]
    got = [(*g[:6], b"" if g[6] is None and g[2] == "response" else g[6]) for g in got]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert warc.archived(df.where("false")).collect() == []


def test_a_task_for_every_archive(spark, monkeypatch):
    """Several archives a writing task, and each read by a task of its own."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    pages = spark.createDataFrame([(i, f"u{i}", words(i, 400)) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    folder = scratch_path(spark, "warc")
    rows = warc.with_referents(pages.withColumnRenamed("page_id", "page").withColumnRenamed("html", "body"), "page", "body")
    archives = materialise(warc.write_archives(rows, folder))
    assert archives.count() > 10
    read = warc.read_archives(archives, folder).withColumn("task", F.spark_partition_id())
    assert read.count() == 40 and read.select("task").distinct().count() > archives.count() // 2
    assert read.rdd.getNumPartitions() == archives.count()


def archive(*records):
    out = b""
    for r in records:
        packer = zlib.compressobj(5, wbits=31)
        out += packer.compress(r) + packer.flush()
    return out


def test_damaged_archives_are_refused():
    payload = b"p" * 5000
    good = warc.record(1, "u", payload, hashlib.sha256(payload).hexdigest(), None)
    whole = archive(good, good)
    assert [len(b) for _, b in warc.records_of(io.BytesIO(whole))] == [5000, 5000]
    for bad in (whole[:-5], archive(good[:-10]), archive(good.replace(b"Content-Length: 5000", b"Content-Length: 4000")),
                archive(good.replace(b"Content-Length: 5000\r\n", b"")), archive(b"nothing"), whole[:60] + b"\0" * 40 + whole[100:]):
        with pytest.raises(ValueError):
            list(warc.records_of(io.BytesIO(bad)))
