"""Approximate nearest neighbours by inner product, over balanced posting lists.

The largest inner product becomes the smallest distance by one more coordinate, which fills every
vector up to the largest norm.  On a bounded sample (at most ``SAMPLE_ROWS`` rows and
``SAMPLE_BYTES``) the driver fits centroids whose lists are balanced: a list with more than its share
becomes dearer until it has given members away.  A graph over the centroids, small enough for a
broadcast, finds the nearest ones of any vector by a best-first search.  Every vector goes to its
nearest list, and a vector near a border also to further lists that are nearly as near (``BORDER``
times the distance at most, ``COPIES`` lists in all).  A query reads the lists within ``RATIO`` times
the distance of its nearest one, and further ones while these hold too few vectors.  All rows are indexed; only the centroids come from a sample.

Neighbouring lists are read together as one group, so that a vector or query goes to a task once
and not once a list; a group beyond ``GROUP_BYTES`` is divided into blocks, whose results are merged.
Candidates are compared in double precision; the best are scored again term by term from the first
coordinate on, which makes their scores and order independent of blocks.

Equal vectors are one entry with the smallest ids that could be among the results, and one query,
so copies cost no more than their rows.  Vectors are told apart by 128 bits of xxhash64.

Rows take no part whose id is null, or whose vector is null, empty, all zero, or holds a null or a
component that is not finite, or whose length is not the most common one (the longest of equally
common ones).  A repeated row is a row of its own: a query's own row alone is left out.  Of equal
scores the smaller id comes first.  Without vectors or queries the result is empty.  Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from firnspark.llm.common import batches
from firnspark.operators.lookup import lookup_join
from firnspark.session import materialise

TOP = 20
SAMPLE_ROWS, SAMPLE_BYTES = 1 << 15, 16 << 20
# Vectors a list should have, and the least number of sampled vectors for a list.
LIST_ROWS, SAMPLE_SHARE = 512, 16
# A vector goes to lists at most so many times as far as its nearest one, and to so many at most.
BORDER, COPIES = 1.05, 2
# A query reads lists at most so many times as far as its nearest one, and so many at most.
RATIO, PROBES = 1.15, 192
ROUNDS = 10
# A list with so many times its share of the sample is halved.
LARGE = 1.5
# Neighbours of a centroid in the graph, and how many of them are drawn from all centroids.
DEGREE, FAR = 24, 6
# Vectors and queries of a block.
GROUP_BYTES = 4 << 20
# Kept beyond the results wanted before scores are worked out again.
SPARE = 11
STEP_CELLS = 1 << 21


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of c."""
    return np.maximum((x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * (x @ c.T), 0)


def halved(x: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of the rows, cut across the direction in which they are spread most."""
    held = x[rows] - x[rows].mean(axis=0)
    order = np.argsort(held @ np.linalg.eigh(held.T @ held)[1][:, -1], kind="stable")
    return rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]


def balanced_centroids(x: np.ndarray, lists: int, seed: int = 7) -> np.ndarray:
    """Centroids whose lists over ``x`` are of nearly equal size, ``lists`` or somewhat more: nearest ones under
    prices that rise with a list's excess over its share; what is still too large then is halved."""
    draw = np.random.default_rng(seed)
    centres = x[draw.choice(len(x), lists, replace=False)].copy()
    price, share = np.zeros(lists), len(x) / lists
    step = max(STEP_CELLS // lists, 1)
    for _ in range(ROUNDS):
        own, near = np.empty(len(x), np.int64), np.empty(len(x))
        for lo in range(0, len(x), step):
            d = distances(x[lo : lo + step], centres)
            own[lo : lo + step] = np.argmin(d + price, axis=1)
            near[lo : lo + step] = d[np.arange(len(d)), own[lo : lo + step]]
        size = np.bincount(own, minlength=lists)
        price += 0.05 * near.mean() * np.clip(size / share - 1, -1, 3)
        sums = np.zeros(centres.shape)
        np.add.at(sums, own, x)
        full = size > 0
        centres[full] = sums[full] / size[full, None]
        # A list without members starts again at a vector that is far from its own.
        centres[~full] = x[np.argsort(-near, kind="stable")[: int((~full).sum())]]
    own = np.concatenate([np.argmin(distances(x[lo : lo + step], centres), axis=1) for lo in range(0, len(x), step)])
    waiting, kept = [np.flatnonzero(own == i) for i in range(lists)], []
    while waiting:
        rows = waiting.pop()
        if len(rows) > max(LARGE * share, 1):
            waiting += halved(x, rows)
        elif len(rows):
            kept.append(x[rows].mean(axis=0))
    return np.array(kept)


class Graph:
    """Links between near centroids and some far ones, searched best first."""

    def __init__(self, centres: np.ndarray, seed: int = 11) -> None:
        self.centres = centres
        n = len(centres)
        draw = np.random.default_rng(seed)
        near = min(DEGREE, n - 1)
        self.links = np.empty((n, near + (FAR if n > near + 1 else 0)), np.int64)
        step = max(STEP_CELLS // n, 1)
        for lo in range(0, n, step):
            d = distances(centres[lo : lo + step], centres)
            d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
            self.links[lo : lo + step, :near] = np.argsort(d, axis=1, kind="stable")[:, :near]
        if n > near + 1:
            self.links[:, near:] = draw.integers(0, n, (n, FAR))
        self.entries = draw.choice(n, min(16, n), replace=False)

    def _measured(self, x: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        d = self.centres[nodes] - x[:, None, :]
        return np.einsum("ijk,ijk->ij", d, d)

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest nodes found for every row of x, at most ``width``, nearest first, and their distances;
        missing ones are -1 and infinitely far."""
        width = min(width, len(self.centres))
        beam = np.tile(self.entries, (len(x), 1))
        far = self._measured(x, beam)
        opened = np.zeros(beam.shape, dtype=bool)
        each = max(2, width // 16)
        rows = np.arange(len(x))[:, None]
        while True:
            # The nearest nodes of each row whose links have not been followed.
            waiting = np.where(opened, np.inf, far)
            pick = np.argsort(waiting, axis=1, kind="stable")[:, :each]
            live = np.isfinite(waiting[rows, pick])
            if not live.any():
                break
            opened[rows, pick] = True
            new = np.where(live[:, :, None], self.links[np.maximum(beam[rows, pick], 0)], -1).reshape(len(x), -1)
            d = np.where(new >= 0, self._measured(x, np.maximum(new, 0)), np.inf)
            beam, far = np.hstack([beam, new]), np.hstack([far, d])
            opened = np.hstack([opened, np.zeros(new.shape, dtype=bool)])
            # Of a node met twice the first place counts.
            order = np.argsort(beam, axis=1, kind="stable")
            held = beam[rows, order]
            again = np.zeros(held.shape, dtype=bool)
            again[:, 1:] = held[:, 1:] == held[:, :-1]
            gone = np.empty_like(again)
            gone[rows, order] = again
            far[gone], opened[gone] = np.inf, True
            order = np.argsort(far, axis=1, kind="stable")[:, :width]
            beam, far, opened = beam[rows, order], far[rows, order], opened[rows, order]
            opened |= ~np.isfinite(far)
        order = np.argsort(far, axis=1, kind="stable")
        beam, far = beam[rows, order], np.sqrt(far[rows, order])
        return np.where(np.isfinite(far), beam, -1), far


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(-1, dim)


def _filled(x: np.ndarray, top: float) -> np.ndarray:
    """Vectors with the coordinate that brings them to the largest norm."""
    x = x.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0))])


def _lists(graph: Graph, x: np.ndarray, most: int, ratio: float, sizes: np.ndarray | None = None, least: int = 0) -> pa.ListArray:
    """The lists of every row: its nearest one, and those at most ``ratio`` times as far; with ``sizes`` also
    further ones, until they have ``least`` members."""
    parts, step = [], max(STEP_CELLS // (x.shape[1] * (DEGREE + FAR) * max(2, most // 16)), 1)
    for lo in range(0, len(x), step):
        found, far = graph.search(x[lo : lo + step], max(most, 16))
        near = (found >= 0) & (far <= far[:, :1] * ratio + 1e-12)
        if sizes is not None:
            held = np.where(found >= 0, sizes[found], 0)
            near |= (found >= 0) & (np.cumsum(held, axis=1) - held < least)
        near[:, most:] = False
        parts.append((near.sum(axis=1), found[near]))
    cuts = np.concatenate([[0], np.cumsum(np.concatenate([n for n, _ in parts]))])
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate([v for _, v in parts]), pa.int32()))


def grouped_lists(centres: np.ndarray, sizes: np.ndarray, most: float) -> np.ndarray:
    """Neighbouring lists put together, by halving along the direction they are spread most, until a group
    has at most ``most`` rows or one list."""
    group, waiting, n = np.zeros(len(centres), np.int64), [np.arange(len(centres))], 0
    while waiting:
        own = waiting.pop()
        if len(own) == 1 or sizes[own].sum() <= most:
            group[own] = n
            n += 1
            continue
        x = centres[own] - centres[own].mean(axis=0)
        along = x @ np.linalg.eigh(x.T @ x)[1][:, -1]
        own = own[np.argsort(along, kind="stable")]
        half = np.searchsorted(np.cumsum(sizes[own]), sizes[own].sum() / 2)
        half = min(max(int(half), 1), len(own) - 1)
        waiting += [own[half:], own[:half]]
    return group


def by_list(column: pa.ListArray, rows: np.ndarray, wanted: np.ndarray) -> dict[int, np.ndarray]:
    """Of each wanted list, the places among ``rows`` of those that name it."""
    lengths = np.asarray(column.value_lengths()).astype(np.int64)
    lists, row = np.asarray(column.flatten()).astype(np.int64), np.repeat(np.arange(len(lengths)), lengths)
    place = np.full(len(lengths), -1, np.int64)
    place[rows] = np.arange(len(rows))
    keep = (place[row] >= 0) & np.isin(lists, wanted)
    lists, row = lists[keep], place[row[keep]]
    order = np.lexsort([row, lists])
    lists, row = lists[order], row[order]
    names, first = np.unique(lists, return_index=True)
    return dict(zip(names.tolist(), np.split(row, first[1:]), strict=True)) if len(names) else {}


def compared(
    q: np.ndarray, q_lists: dict[int, np.ndarray], v: np.ndarray, v_lists: dict[int, np.ndarray], keep: int
) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) places of the ``keep`` best vectors of each query by inner product, among those that
    share a list with it.  Vectors come in the order of their ids."""
    qa, vb, best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    for one in sorted(q_lists.keys() & v_lists.keys()):
        own, b = q_lists[one], v_lists[one]
        step = max(STEP_CELLS // len(b), 1)
        found = [(qa, vb, best)]
        for lo in range(0, len(own), step):
            rows = own[lo : lo + step]
            score = q[rows] @ v[b].T
            i, j = np.nonzero(score >= np.partition(score, max(len(b) - keep, 0), axis=1)[:, [max(len(b) - keep, 0)]])
            found.append((rows[i], b[j], score[i, j]))
        qa, vb, best = (np.concatenate(c) for c in zip(*found, strict=True))
        once = np.unique(qa * len(v) + vb, return_index=True)[1]
        order = once[np.lexsort([vb[once], -best[once], qa[once]])]
        qa, vb, best = qa[order], vb[order], best[order]
        first = np.arange(len(qa)) - np.searchsorted(qa, qa) < keep
        qa, vb, best = qa[first], vb[first], best[first]
    return qa, vb


def in_order_products(q: np.ndarray, v: np.ndarray, qa: np.ndarray, vb: np.ndarray) -> np.ndarray:
    """Inner products of pairs, added up from the first coordinate on."""
    out, step = np.empty(len(qa)), max(STEP_CELLS // q.shape[1], 1)
    for lo in range(0, len(qa), step):
        out[lo : lo + step] = np.cumsum(q[qa[lo : lo + step]] * v[vb[lo : lo + step]], axis=1)[:, -1]
    return out


RESULT = "h1 bigint, h2 bigint, scores array<double>, found array<bigint>, turns array<int>"


def _searched(block: pa.Table, dim: int, group_of: np.ndarray, top: int) -> pa.Table:
    """The best entries of each query of a block.  An entry is a score, an id, and a turn: twice its place
    among the ids of its vector, plus one if that is the query's own vector."""
    block = block.combine_chunks()
    wanted = np.flatnonzero(group_of == block.column("grp")[0].as_py())
    asks = np.asarray(block.column("asks").combine_chunks().cast(pa.int8())).astype(bool)
    h1, h2 = (np.asarray(block.column(c)) for c in ("h1", "h2"))
    ids, lists = block.column("ids").combine_chunks(), block.column("lists").combine_chunks()
    matrix = _matrix(block.column("vec"), dim)

    def once(rows: np.ndarray) -> np.ndarray:
        return rows[np.unique(np.stack([h1[rows], h2[rows]]), axis=1, return_index=True)[1]]

    queries, vectors = once(np.flatnonzero(asks)), once(np.flatnonzero(~asks))
    id_counts = np.asarray(ids.value_lengths()).astype(np.int64)
    id_first, id_values = np.cumsum(id_counts) - id_counts, np.asarray(ids.flatten())
    if len(vectors):
        vectors = vectors[np.argsort(id_values[id_first[vectors]], kind="stable")]
    q, v = matrix[queries].astype(np.float64), matrix[vectors].astype(np.float64)
    qa, vb = compared(q, by_list(lists, queries, wanted), v, by_list(lists, vectors, wanted), top + SPARE)
    score, at = in_order_products(q, v, qa, vb), vectors[vb]
    own = (h1[queries[qa]] == h1[at]) & (h2[queries[qa]] == h2[at])
    n = id_counts[at]
    turn = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    found = id_values[np.repeat(id_first[at], n) + turn]
    qa, score, turn = np.repeat(qa, n), np.repeat(score, n), 2 * turn + np.repeat(own, n)
    order = np.lexsort([turn, found, -score, qa])
    order = order[np.arange(len(order)) - np.searchsorted(qa[order], qa[order]) < top]
    qa, score, found, turn = qa[order], score[order], found[order], turn[order]
    full, size = np.unique(qa, return_counts=True)
    cuts = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
    values = (pa.array(score), pa.array(found), pa.array(turn, pa.int32()))
    columns = [pa.array(h1[queries[full]]), pa.array(h2[queries[full]]), *(pa.ListArray.from_arrays(cuts, x) for x in values)]
    return pa.table(columns, names=["h1", "h2", "scores", "found", "turns"])


def _prepared(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, int, float]:
    """Rows that take part, with the two halves of their vector's hash; the dimension and the largest squared norm."""
    kind = vectors.schema[vector_column].dataType.elementType.simpleString()
    # Adding nothing turns a negative zero into a plain one.
    vec = F.transform(F.col(vector_column), lambda x: x + F.lit(0).cast(kind))
    df = vectors.select(F.col(id_column).cast("long").alias("id"), vec.alias("vec")).dropna()
    df = df.where("not exists(vec, x -> x is null or isnan(x) or abs(cast(x as double)) = double('infinity')) and exists(vec, x -> x <> 0)")
    df = df.withColumn("sq", F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    often = df.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n"), F.max("sq").alias("top"))
    common = often.orderBy(F.desc("n"), F.desc("dim")).first()
    dim, top = (common["dim"], common["top"]) if common else (0, 0.0)
    df = df.where(F.size("vec") == dim).select("id", "vec", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"))
    return df, dim, top


def nearest(
    vectors: DataFrame,
    queries: str | Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    top: int = TOP,
) -> DataFrame:
    """The ``top`` nearest rows found for every row that ``queries``, a condition on the id, selects:
    query_id, rank from 1, id and score."""
    spark = vectors.sparkSession
    asked = vectors.where(queries)
    rows, dim, top_norm = _prepared(vectors, id_column, vector_column)
    keys = ["h1", "h2"]
    # Copies: their smallest ids go with the row of the smallest one.
    groups = materialise(rows.groupBy(*keys).agg(F.count("*").alias("n")), "vector-groups")
    entries = groups.count()
    often = groups.where("n > 1").select(*keys)
    first = Window.partitionBy(*keys).orderBy("id")
    copies = lookup_join(rows.select("id", *keys), often, keys, row_bytes=64)
    copies = copies.withColumn("at", F.row_number().over(first)).where(F.col("at") <= top + 1)
    copies = materialise(copies.groupBy(*keys).agg(F.sort_array(F.collect_list("id")).alias("ids")), "vector-copies")
    rows = lookup_join(rows, copies, keys, "left", row_bytes=64 + 8 * (top + 1))
    rows = rows.where("ids is null or id = ids[0]").select(*keys, "vec", F.coalesce("ids", F.array("id")).alias("ids"))

    known, _, _ = _prepared(asked, id_column, vector_column)
    known = known.where(F.size("vec") == dim)
    result = f"query_id bigint, rank int, {id_column} bigint, score double"
    if not entries:
        return spark.createDataFrame([], result)
    most = max(min(SAMPLE_ROWS, SAMPLE_BYTES // (4 * dim)), 1)
    share = min(most / entries, 1.0)
    sample = rows.where(F.pmod("h1", F.lit(1 << 30)) <= int(share * (1 << 30))).orderBy(*keys).limit(most).select("vec").toArrow()
    sample = _filled(_matrix(sample.column("vec"), dim), top_norm)
    lists = int(np.clip(entries // LIST_ROWS, 1, max(len(sample) // SAMPLE_SHARE, 1)))
    graph = Graph(balanced_centroids(sample, lists))
    lists = len(graph.centres)
    sent = spark.sparkContext.broadcast(graph)
    columns = f"h1 bigint, h2 bigint, vec {rows.schema['vec'].dataType.simpleString()}, ids array<bigint>, lists array<int>"

    def placed(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            x = _filled(_matrix(batch.column("vec"), dim), top_norm)
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(sent.value, x, COPIES, BORDER)], [*batch.schema.names, "lists"])

    def probed(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            # A query has nothing in the added coordinate; its length does not change the order.
            x = _matrix(batch.column("vec"), dim).astype(np.float64)
            x = np.column_stack([x * np.sqrt(top_norm / (x * x).sum(axis=1, keepdims=True)), np.zeros(len(x))])
            # Enough members for all results, though a vector may be in several lists.
            found = _lists(sent.value, x, PROBES, RATIO, sizes, COPIES * (top + 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "lists"])

    stored = materialise(rows.mapInArrow(placed, columns), "vector-lists")
    # One row a list: their number is bounded by that of the centroids.
    sizes = np.zeros(lists, np.int64)
    for r in stored.select(F.explode("lists").alias("one")).groupBy("one").count().collect():
        sizes[r["one"]] = r["count"]
    wanted = known.groupBy(*keys).agg(F.first("vec").alias("vec")).withColumn("ids", F.array().cast("array<bigint>"))
    wanted = materialise(wanted.mapInArrow(probed, columns), "query-lists")
    block = max(GROUP_BYTES // (4 * dim), 1)
    group_of = grouped_lists(graph.centres, sizes, block)
    found = _blocks(stored, wanted, group_of, block, dim).groupBy("cell").applyInArrow(
        lambda table: _searched(table, dim, group_of, top + 1), RESULT
    )
    entry = F.transform(
        F.arrays_zip("scores", "found", "turns"),
        lambda e: F.struct((-e["scores"]).alias("less"), e["found"].alias("id"), e["turns"].alias("turn")),
    )
    # A query has one row of each group and block it was compared with.
    best = found.groupBy(*keys).agg(F.flatten(F.collect_list(entry)).alias("entries"))
    best = best.select(*keys, F.slice(F.array_sort(F.array_distinct("entries")), 1, top + 1).alias("entries"))
    best = materialise(best, "vector-results")
    own = "array_position(transform(entries, e -> e.id = query_id and e.turn % 2 = 1), true)"
    named = known.select(F.col("id").alias("query_id"), *keys).join(best, keys)
    named = named.withColumn("own", F.expr(own)).withColumn("entries", F.expr("filter(entries, (e, i) -> i + 1 <> own)"))
    out = named.select("query_id", F.posexplode(F.slice("entries", 1, top)))
    return out.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("col.id").alias(id_column), (-F.col("col.less")).alias("score"))


def _blocks(stored: DataFrame, wanted: DataFrame, group_of: np.ndarray, block: int, dim: int) -> DataFrame:
    """Vectors and queries, each once for every block it is read in.  A group's vectors and its queries are
    divided by hash into blocks of bounded size, and every block of the one meets every block of the other."""
    spark = stored.sparkSession

    def groups(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            lists = batch.column("lists")
            row = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths()))
            pairs = np.unique(np.stack([row, group_of[np.asarray(lists.flatten())]]), axis=1)
            taken = batch.take(pa.array(pairs[0]))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(pairs[1])], [*batch.schema.names, "grp"])

    def spread(df: DataFrame) -> DataFrame:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
        return df.mapInArrow(groups, f"{columns}, grp bigint")

    counts = []
    for df in (stored, wanted):
        n = spread(df.select("h1", "lists")).groupBy("grp").count().collect()
        counts.append({r["grp"]: -(-r["count"] // block) for r in n})
    names = sorted(counts[0].keys() & counts[1].keys())
    plan = spark.createDataFrame([(g, counts[0][g], counts[1][g]) for g in names], "grp bigint, vector_blocks bigint, query_blocks bigint")

    def dealt(df: DataFrame, asks: bool) -> DataFrame:
        own, other = ("query_blocks", "vector_blocks") if asks else ("vector_blocks", "query_blocks")
        # At most one row for each list of the fitted centroids.
        df = spread(df).join(F.broadcast(plan), "grp").withColumn("own", F.expr(f"pmod(h2, {own})"))
        df = df.withColumn("other", F.explode(F.expr(f"sequence(0, {other} - 1)")))
        a, b = ("own", "other") if asks else ("other", "own")
        return df.select(F.xxhash64("grp", a, b).alias("cell"), "grp", F.lit(asks).alias("asks"), "h1", "h2", "vec", "ids", "lists")

    return dealt(stored, False).unionByName(dealt(wanted, True))
