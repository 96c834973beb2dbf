"""Near-duplicate documents: a multi-index Hamming join over b-bit MinHash signatures.

A document's set is its distinct word shingles.  Its signature has ``CHUNKS`` chunks of
``WIDTH`` MinHash symbols of 32 bits.  If two signatures differ in at most
``CHUNKS * (ERRORS + 1) - 1`` symbols, then by pigeonhole some chunk has at most ``ERRORS``
of the differences, so the two share one of the chunk's choices of ``WIDTH - ERRORS``
symbols.  Every choice of every chunk becomes an index key, so equality on keys finds all
pairs under that distance.  With the defaults that is distance 20 of 28, which a pair of
similarity 0.75 exceeds with a chance of about 1e-7.

Pairs within a key are not expanded.  Members are first compared with three agreed
members of their key; found links merge most of a group.  Then only members of different
components are compared.  A key with very many of those is divided into blocks: the members of its largest
component on one side, all others on the other, and every two blocks that can hold a pair meet in one task, so
the distance found for certain is the same for keys of any size.  Hopeless pairs are ruled out by their sizes, by a
second signature of 64 symbols of 2 bits (a pair of similarity 0.75 fails it with a chance of about 1e-7), and
by a parity sketch: each shingle toggles one of
``PARITY_BITS`` bits, so two sketches never differ in more bits than the sets differ in
shingles, and this test loses nothing.  Every link is confirmed on the full sets.

Sets are taken as equal when their sizes and two independent 64-bit sums over their shingles agree.
Nulls, empty texts: an empty set, linked with nothing.  A null id is linked with nothing.
Rows repeating an id are one document.  Equal texts are one class from the start.  Ties
need no rule: a component is named by its smallest id.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from firnspark.llm.common import batches, components, mix64, text_or_empty, text_steps, word_hashes
from firnspark.operators.lookup import lookup_join
from firnspark.session import materialise

SHINGLE = 5
SIMILARITY = 75  # per cent
CHUNKS, WIDTH, ERRORS = 7, 4, 2
SYMBOLS = CHUNKS * WIDTH
SKETCH = 64
# Most differing 2-bit symbols of 64 in a pair worth confirming: 12 expected at similarity 0.75, and 6 deviations.
SKETCH_ERRORS = 31
PARITY_BITS = 1024
# Members of one key, still in different components, in a block.
LARGE_KEY = 8192
BLOCK = 256

_rng = np.random.default_rng(75)
_SEEDS = _rng.integers(1, 2**63, SYMBOLS + SKETCH, dtype=np.uint64)
_FACTORS = _rng.integers(1, 2**63, SYMBOLS + SKETCH, dtype=np.uint64) | np.uint64(1)
_STEPS = _rng.integers(1, 2**63, SHINGLE + 1, dtype=np.uint64) | np.uint64(1)
# Agreed members of a key: those whose id is smallest after toggling these bits.
_MASKS = (0, 0x2AAAAAAAAAAAAAAA, 0x0F3C5A69F0C3A596)
_PAIR_BITS = 0x5555555555555555


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and the offsets of each text's set."""
    words, counts = word_hashes(data, offsets)
    total = len(words)
    first = np.cumsum(counts) - counts
    ahead = np.repeat(first + counts, counts) - np.arange(total)
    padded = np.concatenate([words, np.zeros(SHINGLE - 1, np.uint64)])
    values = np.full(total, SHINGLE, np.uint64) * _STEPS[SHINGLE]
    for j in range(SHINGLE):
        values += padded[j : j + total] * _STEPS[j]
    valid = ahead >= SHINGLE
    for text in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        n, at = int(counts[text]), int(first[text])
        valid[at] = True
        values[at : at + 1] = np.full(1, n, np.uint64) * _STEPS[SHINGLE] + (words[at : at + n] * _STEPS[:n]).sum()
    values = mix64(values[valid])
    bounds = np.concatenate([[0], np.cumsum(np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1)))])
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        values[a:b].sort()
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    new[bounds[:-1][bounds[:-1] < len(values)]] = True
    return values[new], np.concatenate([[0], np.cumsum(new)])[bounds]


def signatures(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols (texts x SYMBOLS, 32 bits) and sketches (texts x 2, 64 bits) of non-empty sets."""
    texts = len(bounds) - 1
    symbols = np.zeros((texts, SYMBOLS), np.uint32)
    sketch = np.zeros((texts, 2), np.uint64)
    for i, (seed, factor) in enumerate(zip(_SEEDS, _FACTORS, strict=True)):
        least = mix64(np.minimum.reduceat((values ^ seed) * factor, bounds[:-1]))
        if i < SYMBOLS:
            symbols[:, i] = least >> np.uint64(32)
        else:
            word, slot = divmod(i - SYMBOLS, 32)
            sketch[:, word] |= (least >> np.uint64(62)) << np.uint64(2 * slot)
    return symbols, sketch


def parity_sketches(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text, the parities of the counts of shingles per bit, as 64-bit words."""
    texts = len(bounds) - 1
    slot = np.repeat(np.arange(texts) * PARITY_BITS, np.diff(bounds)) + (values % np.uint64(PARITY_BITS)).astype(np.int64)
    odd = (np.bincount(slot, minlength=texts * PARITY_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.uint64).reshape(texts, PARITY_BITS // 64)


def _long_lists(rows: np.ndarray) -> pa.Array:
    """A list column of 64-bit words from a matrix."""
    at = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(at), pa.array(rows.reshape(-1).view(np.int64)))


def _signature_rows(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(table):
        for lo, hi, data, offsets in text_steps(batch.column(1)):
            values, bounds = shingle_sets(data, offsets)
            sizes = np.diff(bounds)
            full = sizes > 0
            held = np.concatenate([[0], np.cumsum(sizes[full])])
            symbols = np.zeros((hi - lo, SYMBOLS), np.uint32)
            columns = np.zeros((4, hi - lo), np.uint64)
            if full.any():
                symbols[full], sketch = signatures(values, held)
                columns[2:, full] = sketch.T
                columns[0, full] = np.add.reduceat(values, held[:-1])
                columns[1, full] = np.add.reduceat(mix64(values + _STEPS[0]), held[:-1])
            packed = pa.array([row.tobytes() for row in symbols], pa.binary())
            longs = [pa.array(c.view(np.int64)) for c in columns]
            odd = _long_lists(parity_sketches(values, bounds))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(sizes.astype(np.int64)), *longs, odd, packed],
                ["id", "n", "d1", "d2", "s1", "s2", "odd", "symbols"],
            )


def _set_rows(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(table):
        for lo, hi, data, offsets in text_steps(batch.column(1)):
            values, bounds = shingle_sets(data, offsets)
            sets = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), sets], ["id", "shingles"])


def _key_rows(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    choices = [
        (chunk, tuple(chunk * WIDTH + i for i in kept))
        for chunk in range(CHUNKS)
        for kept in combinations(range(WIDTH), WIDTH - ERRORS)
    ]
    for batch in batches(table):
        n = batch.num_rows
        symbols = np.frombuffer(b"".join(batch.column("symbols").to_pylist()), np.uint32).reshape(n, SYMBOLS)
        symbols = symbols.astype(np.uint64)
        keys = np.empty((len(choices), n), np.uint64)
        for row, (chunk, kept) in enumerate(choices):
            key = np.full(n, row + 1, np.uint64)
            for i in kept:
                key = mix64(key ^ symbols[:, i]) * _STEPS[1]
            keys[row] = (key & ~np.uint64(7)) | np.uint64(chunk)
        ids = np.tile(np.asarray(batch.column("id")), len(choices))
        yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(ids)], ["key", "id"])


def _differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing 2-bit symbols of sketch words, all against all."""
    z = x[:, None] ^ y[None, :]
    return np.bitwise_count((z | (z >> np.uint64(1))) & np.uint64(_PAIR_BITS))


def _cross_pairs(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Plausible pairs of different components within each key, from rows sorted by key.  Where rows have
    a side of 0 or 1, only pairs of both sides count."""

    def pairs(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(held)
        ids, comps, sizes = rows[:, 0], rows[:, 1], rows[:, 2]
        s1, s2, side, odd = rows[:, 3].view(np.uint64), rows[:, 4].view(np.uint64), rows[:, 5], rows[:, 6:].view(np.uint64)
        for i in range(0, len(ids), BLOCK):
            for j in range(i, len(ids), BLOCK):
                a, b = slice(i, i + BLOCK), slice(j, j + BLOCK)
                near = _differing(s1[a], s1[b]) + _differing(s2[a], s2[b]) <= SKETCH_ERRORS
                near &= comps[a][:, None] != comps[b][None, :]
                near &= (side[a][:, None] < 0) | (side[a][:, None] != side[b][None, :])
                low = np.minimum(sizes[a][:, None], sizes[b][None, :])
                near &= 100 * low >= SIMILARITY * np.maximum(sizes[a][:, None], sizes[b][None, :])
                x, y = np.nonzero(near)
                if i == j:
                    x, y = x[x < y], y[x < y]
                unlike = np.bitwise_count(odd[a][x] ^ odd[b][y]).sum(axis=1, dtype=np.int64)
                kept = (100 + SIMILARITY) * unlike <= (100 - SIMILARITY) * (sizes[a][x] + sizes[b][y])
                x, y = ids[a][x[kept]], ids[b][y[kept]]
                if len(x):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"]
                    )

    held, key = [], None
    for batch in batches(table):
        keys = np.asarray(batch.column("key"))
        thin = np.stack([np.asarray(batch.column(c)) for c in ("id", "component", "n", "s1", "s2", "side")], axis=1)
        odd = np.asarray(batch.column("odd").flatten()).reshape(len(keys), -1)
        rows = np.concatenate([thin, odd], axis=1)
        cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if key is not None and keys[lo] != key:
                yield from pairs(held)
                held = []
            key = keys[lo]
            held.append(rows[lo:hi])
    if held:
        yield from pairs(held)


def _sketch_distance() -> Column:
    def part(name: str) -> str:
        x = f"(a_{name} ^ b_{name})"
        return f"bit_count(({x} | shiftrightunsigned({x}, 1)) & {_PAIR_BITS}L)"

    return F.expr(f"{part('s1')} + {part('s2')}")


def _plausible(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow a link."""
    side = {
        s: texts.select(F.col("id").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("n", "s1", "s2", "odd")]) for s in "ab"
    }
    sizes = F.expr(f"100 * least(a_n, b_n) >= {SIMILARITY} * greatest(a_n, b_n)")
    unlike = F.expr("aggregate(zip_with(a_odd, b_odd, (x, y) -> bit_count(x ^ y)), 0, (s, v) -> s + v)")
    odd = (100 + SIMILARITY) * unlike <= (100 - SIMILARITY) * (F.col("a_n") + F.col("b_n"))
    near = pairs.join(side["a"], "a").join(side["b"], "b").where(sizes & (_sketch_distance() <= SKETCH_ERRORS))
    return near.where(odd).select("a", "b")


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs, a stored frame, whose full sets have the wanted similarity."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    needed = materialise(needed, "near-ids", rows=2 * pairs.count())
    sets = materialise(
        docs.join(needed, "id", "left_semi").mapInArrow(_set_rows, "id bigint, shingles array<bigint>"), "near-sets"
    )
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    return both.where(100 * shared >= SIMILARITY * union).select("a", "b")


def _in_blocks(members: DataFrame) -> DataFrame:
    """The (key, id, component) rows of large keys, once for every two blocks that they are compared in, with
    a key for the two and the side a row is on (-1 within one block)."""
    sizes = materialise(members.groupBy("key", "component").agg(F.count("*").alias("n")), "near-sizes")
    main = sizes.groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("main_n"), F.sum("n").alias("n")
    )
    blocks = [f"cast(greatest(1, ceil({n} / {LARGE_KEY})) as bigint)" for n in ("main_n", "(n - main_n)")]
    main = materialise(main.select("key", "main", F.expr(blocks[0]).alias("main_blocks"), F.expr(blocks[1]).alias("rest_blocks")), "near-mains")
    held = lookup_join(members, main, ["key"], row_bytes=64)
    own = "pmod(xxhash64(id), if(component = main, main_blocks, rest_blocks))"
    rest, others = "sequence(0L, rest_blocks - 1)", "sequence(0L, main_blocks - 1)"
    met = (
        f"if(component = main, transform({rest}, x -> named_struct('kind', 0, 'x', own, 'y', x, 'side', 0L)), "
        f"concat(transform({others}, x -> named_struct('kind', 0, 'x', x, 'y', own, 'side', 1L)), "
        f"transform({rest}, x -> named_struct('kind', 1, 'x', least(x, own), 'y', greatest(x, own), "
        "'side', case when x = own then -1L when own < x then 0L else 1L end))))"
    )
    held = held.withColumn("own", F.expr(own)).withColumn("met", F.explode(F.expr(met)))
    return held.select(F.expr("xxhash64(key, met.kind, met.x, met.y)").alias("key"), "id", "component", F.col("met.side").alias("side"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (null for a null id) and kept.

    ``kept`` holds for the smallest id of a component, and for rows without an id.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("id"), text_or_empty(text_column).alias("text"))
    schema = "id bigint, n bigint, d1 bigint, d2 bigint, s1 bigint, s2 bigint, odd array<bigint>, symbols binary"
    signed = materialise(docs.mapInArrow(_signature_rows, schema), "near-signatures")
    full = signed.where("id is not null and n > 0")
    # Classes of equal sets: their smallest id stands for them.
    same = full.groupBy("n", "d1", "d2").agg(F.min("id").alias("top"), F.max("id").alias("last"))
    same = materialise(same.where("top < last").drop("last"), "near-classes")
    classed = materialise(
        full.select("id", "n", "d1", "d2").join(same, ["n", "d1", "d2"], "left")
        .select("id", "n", F.coalesce("top", "id").alias("top")), "near-members"
    )
    tops = classed.where("id = top").select("id").distinct()
    texts = full.join(tops, "id", "left_semi")
    sketches = materialise(texts.select("id", "n", "s1", "s2", "odd", "symbols"), "near-texts")
    keys = sketches.select("id", "symbols").mapInArrow(_key_rows, "key bigint, id bigint")
    within = Window.partitionBy("key")
    agreed = [F.min(F.col("id").bitwiseXOR(F.lit(mask))).over(within).bitwiseXOR(F.lit(mask)) for mask in _MASKS]
    shared = materialise(
        keys.withColumn("agreed", F.array(*agreed)).withColumn("members", F.count("*").over(within))
        .where("members > 1").drop("members"), "near-keys"
    )

    towards = shared.select("id", F.explode("agreed").alias("other")).where("id <> other")
    towards = towards.selectExpr("least(id, other) a", "greatest(id, other) b").distinct()
    tried = materialise(_plausible(towards, sketches), "near-pairs")
    links = materialise(_confirmed(tried, docs), "near-links")

    merged = components(links)
    member = shared.select("key", "id").join(merged, "id", "left").withColumn("component", F.coalesce("component", "id"))
    member = materialise(member, "near-open")
    open_keys = member.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members")
    )
    open_keys = materialise(open_keys.where("low < high").select("key", "members"), "near-open-keys")
    small = member.join(open_keys.where(F.col("members") <= LARGE_KEY), "key").drop("members")
    rows = small.select("key", "id", "component", F.lit(-1).cast("bigint").alias("side"))
    large_keys = open_keys.where(F.col("members") > LARGE_KEY)
    if not large_keys.isEmpty():
        rows = rows.unionByName(_in_blocks(member.join(large_keys, "key").drop("members")))
    rows = rows.join(sketches.drop("symbols"), "id").repartition("key").sortWithinPartitions("key")
    across = rows.mapInArrow(_cross_pairs, "a bigint, b bigint").distinct().join(tried, ["a", "b"], "left_anti")
    across = materialise(across, "near-rest")
    # The components so far stand for the links that made them.
    made = merged.where("id <> component").selectExpr("id a", "component b")

    final = components(made.unionByName(_confirmed(across, docs)))
    labelled = classed.join(final.withColumnRenamed("id", "top"), "top", "left").groupBy("id").agg(
        F.min(F.coalesce("component", "top")).alias("component_id")
    )
    rows = signed.select("id", "n").join(labelled, "id", "left")
    component = F.coalesce("component_id", "id")
    return rows.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
