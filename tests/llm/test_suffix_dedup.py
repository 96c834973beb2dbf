import hashlib
from collections import Counter

import numpy as np
import pytest

from firnspark.llm import suffix_dedup
from firnspark.llm.suffix_dedup import without_repeats
from tests.llm.cases import awkward, awkward_rows, documents, no_rows, words

LENGTH = suffix_dedup.LENGTH


def brute(texts):
    """(bytes, removed, spans, digest) of each text, from a count of all windows."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + LENGTH] for b in raw for i in range(len(b) - LENGTH + 1))
    out = []
    for b in raw:
        cover = np.zeros(len(b) + 1, int)
        for i in range(len(b) - LENGTH + 1):
            if seen[b[i : i + LENGTH]] > 1:
                cover[i] += 1
                cover[i + LENGTH] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def results(df):
    rows = without_repeats(df).collect()
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


def expected(rows):
    return sorted((str(k), *v) for (k, _), v in zip(rows, brute([t for _, t in rows]), strict=True))


@pytest.mark.parametrize("shard", [400, 3000, 2 << 20])
def test_against_all_windows(spark, monkeypatch, shard):
    """Also with shards so small that anchors are divided and merged."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert results(docs) == expected(rows)


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    assert results(awkward(spark)) == expected(rows)


def test_periodic_shared_and_short(spark):
    shared = words(11, 45)
    rows = [
        (1, "ab" * 400), (2, "z" * 199), (3, "z" * 200), (4, "y" * 201), (5, words(12, 80) + shared + words(13, 9)),
        (6, shared + words(14, 90)), (7, shared[:199] + "#" + words(15, 40)), (8, ("line one two three. " * 30) + words(16, 50)),
        (9, "\0" * 300 + words(17, 30)), (10, "\0" * 250),
    ]
    assert results(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)


def test_no_rows(spark):
    assert without_repeats(no_rows(spark)).collect() == []


def test_kept_text_has_whole_characters(spark):
    text = "é" * 150
    rows = [(1, text), (2, "x" + text[:100] + "y"), (3, "kept")]
    got = {r.doc_id: r.kept_text for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "", 2: "xy", 3: "kept"}


def test_suffix_order_and_prefixes():
    draw = np.random.default_rng(3)
    for _ in range(60):
        pieces = [bytes(draw.integers(0, draw.integers(1, 4), draw.integers(1, 50)).astype(np.uint8)) for _ in range(draw.integers(1, 8))]
        data = np.frombuffer(b"".join(pieces), np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        keys = [tuple(x + 1 for x in p[i:]) + (0, k) for k, p in enumerate(pieces) for i in range(len(p))]
        order = suffix_dedup.suffix_array(data, bounds)
        assert list(order) == sorted(range(len(keys)), key=keys.__getitem__)
        before = np.full(len(data), -1, np.int64)
        before[order[1:]] = order[:-1]
        got = suffix_dedup.common_prefixes(data, bounds, before, np.diff(bounds))
        for i, j in enumerate(before):
            n = 0
            while j >= 0 and keys[i][n] == keys[j][n] != 0 and n < len(keys[i]) - 2 and n < len(keys[j]) - 2:
                n += 1
            assert got[i] == n
