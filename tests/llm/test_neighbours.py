import math

import numpy as np
import pytest

from firnspark.llm import neighbours as module
from firnspark.llm.neighbours import Graph, balanced_centroids, distances, grouped_lists, nearest
from tests.llm.cases import SF

ROWS = "vec_id long, embedding array<float>"


def plain(rows, wanted, top):
    """All rows compared with every query, by the position of the row."""
    held = [(n, i, np.array(v, np.float32).astype(float)) for n, (i, v) in enumerate(rows)]
    out = {}
    for n, i, q in held:
        if wanted(i):
            scores = sorted((-float(np.cumsum(q * v)[-1]), j) for m, j, v in held if m != n)[:top]
            out.setdefault(i, []).append([(j, -s) for s, j in scores])
    return out


def rows_of(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


@pytest.mark.parametrize("scale", ["equal norms", "norms of all sizes"])
def test_recall_and_exact_scores(spark, scale, monkeypatch):
    monkeypatch.setattr(module, "LIST_ROWS", 32)
    monkeypatch.setattr(module, "GROUP_BYTES", 64 * 4 * 90)
    draw = np.random.default_rng(3)
    x = draw.normal(size=(2000, 64)) + 1.5 * draw.normal(size=(12, 64))[draw.integers(0, 12, 2000)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if scale != "equal norms":
        x *= draw.uniform(0.6, 1.2, (2000, 1))
    rows = [(i, [float(c) for c in v.astype(np.float32)]) for i, v in enumerate(x)]
    got = rows_of(nearest(spark.createDataFrame(rows, ROWS), "vec_id % 20 = 0"))
    true = plain(rows, lambda i: i % 20 == 0, 20)
    assert got.keys() == true.keys()
    hits = 0
    for i, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21)) and i not in [j for _, j, _ in found]
        q = np.array(rows[i][1], np.float32).astype(float)
        assert [s for _, _, s in found] == [float(np.cumsum(q * np.array(rows[j][1], np.float32))[-1]) for _, j, _ in found]
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        hits += len({j for _, j, _ in found} & {j for j, _ in true[i][0]})
    assert hits / (20 * len(got)) >= 0.9


def test_recall_on_given_table(spark):
    df = spark.read.parquet(f"{SF.replace('sf0.001', 'sf0.1')}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got, true = rows_of(nearest(df, "vec_id % 20 = 0")), plain(rows, lambda i: i % 20 == 0, 20)
    assert got.keys() == true.keys()
    hits = sum(len({j for _, j, _ in got[i]} & {j for j, _ in true[i][0]}) for i in got)
    assert hits / (20 * len(got)) >= 0.9


def awkward_vectors():
    draw = np.random.default_rng(5)
    rows = [(i, [float(v) for v in draw.integers(-3, 4, 4)]) for i in range(40)]
    bad = [
        (100, None), (120, []), (140, [0.0] * 4), (160, [1.0, None, 1.0, 1.0]), (180, [1.0, math.nan, 0.0, 0.0]),
        (200, [math.inf, 0.0, 0.0, 0.0]), (220, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0]), (240, [0.0, -0.0, 0.0, 0.0]),
    ]
    # A group of copies with more members than results, negative zeros among them, and a row given three times.
    copies = [(1000 - i, [2.0, 0.0 if i % 2 else -0.0, 1.0, 0.0]) for i in range(60)]
    return [(i, v) for i, v in rows if any(v)] + copies + [(500, [1.0, 2.0, 0.0, -1.0])] * 3, bad


def test_awkward_rows(spark):
    rows, bad = awkward_vectors()
    df = spark.createDataFrame(rows + bad, ROWS).selectExpr("*", "'x' as h1", "'y' as lists", "'z' as query_id", "'w' as score")
    got, true = rows_of(nearest(df, "vec_id % 20 = 0")), plain(rows, lambda i: i % 20 == 0, 20)
    assert got.keys() == true.keys()
    for i, found in got.items():
        # A row given several times is as many queries with the same result.
        for ranks in (found[k :: len(true[i])] for k in range(len(true[i]))):
            assert [(j, s) for _, j, s in ranks] == true[i][0]


def test_few_rows_and_none(spark):
    assert nearest(spark.createDataFrame([], ROWS), "vec_id % 20 = 0").collect() == []
    assert nearest(spark.createDataFrame([(20, [1.0])], ROWS), "vec_id % 20 = 0").collect() == []
    got = rows_of(nearest(spark.createDataFrame([(20, [1.0, 0.0]), (7, [0.5, 3.0]), (3, [0.5, 1.0])], ROWS), "vec_id % 20 = 0"))
    assert got == {20: [(1, 3, 0.5), (2, 7, 0.5)]}
    assert nearest(spark.createDataFrame([(1, [1.0]), (2, [1.0])], ROWS), "vec_id % 20 = 0").collect() == []


def test_blocks_do_not_change_results(spark, monkeypatch):
    rows, _ = awkward_vectors()
    df = spark.createDataFrame(rows, ROWS)
    whole = rows_of(nearest(df, "vec_id % 3 = 0"))
    monkeypatch.setattr(module, "GROUP_BYTES", 4 * 4 * 7)
    assert rows_of(nearest(df, "vec_id % 3 = 0")) == whole


def test_lists_are_balanced_and_the_graph_finds_the_nearest():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(4000, 16))
    x[:1500] = x[0] + 0.05 * draw.normal(size=(1500, 16))
    centres = balanced_centroids(x, 40)
    size = np.bincount(np.argmin(distances(x, centres), axis=1), minlength=40)
    assert size.max() < 6 * size.mean()
    found, far = Graph(centres).search(x[::7], 16)
    true = np.argsort(distances(x[::7], centres), axis=1)
    assert np.mean(found[:, 0] == true[:, 0]) > 0.98
    assert np.mean([len(set(f[:8]) & set(t[:8])) / 8 for f, t in zip(found, true, strict=True)]) > 0.95
    group = grouped_lists(centres, size, 300)
    assert all(size[group == g].sum() <= 300 or (group == g).sum() == 1 for g in set(group.tolist()))
