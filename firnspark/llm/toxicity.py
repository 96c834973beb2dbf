"""Toxicity scores from two class-conditional Kneser-Ney models that share their backoff.

Words are lower-cased runs of letters and digits, told apart by 64-bit hashes; the word before a
word is told by 32 bits.  Spark gathers, over all labelled rows of the folds learnt from, in how many
texts of each class every pair of a word and the word before it occurs: a table that grows with the
input.  From it come, per class c,

* pairs: P_c(w | v) = (n_c(v, w) - D) / n_c(v) + l_c(v) * S_c(w | v); what the discounts leave over, l_c(v),
  goes to the shared backoff S_c(w | v) = (n(v, w) - D) / n(v) + g(v) * P_c(w) from the counts of both
  classes together;
* words: P_c(w) = (k_c(w) - D) / K_c + L_c * k(w) / K, k being the number of different words before w.

Both are distributions.  Discounts are estimated from the counts of counts of each class, and of both
together, and stay below the count.  The model is a table of (key, log ratio) of every pair, word before others
and word that a text learnt from holds; a pair in none differs between the classes by factors of its two
words, a word in none by one factor.  ``pruned`` models keep only pairs and words that toxic texts hold and leave the
mass of all others over.  Up to ``MODEL_BYTES`` it is broadcast and texts are scored where they are.  Beyond, it is kept as
a row for each range of keys, texts are taken in blocks of about ``BLOCK_BYTES``, the distinct keys of each block are asked
from their ranges, and what these answer meets the block's texts in one task.  Both ways give the same figures.

Disk: a larger model is made in ``SLICES`` and asked in ``ROUNDS``, each of which takes every row whose hash falls to it;
copies and shuffle files of one are gone before the next begins.

A text's evidence is the difference of its log-likelihoods under the two pair models divided by its
number of words, and the highest mean difference under the word models among its stretches of
``STRETCHES`` words.  A logistic curve over these turns them into a score; it is fitted on one fold that
the models have not seen, from at most ``FIT_ROWS`` rows of each class in hash order.  Both classes of
that fold are counted in full and the rows taken weigh as much as their class, so scores keep its true
shares.

Nulls count as empty texts; an empty text has no evidence and gets the curve's base score.
Labels that are null are ignored; of several labels of an id the highest counts.  Without
labels of both classes the score is the share of label 1 (0 if there are none).  Repeated
rows get equal scores; a row with a null id is never held out and never learnt from.  Extra
columns are ignored.  Very long texts are one array step, and one block, each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from firnspark.llm.common import IS_SYMBOL, LOWER, batches, mix64, span_hashes, text_or_empty, text_steps, word_spans
from firnspark.operators.lookup import fits_broadcast, lookup_join
from firnspark.session import discard, gathered, materialise

STRETCHES = (1, 4, 16)
FIT_ROWS = 20_000
FOLDS = 5
FIT_FOLD = 4
RIDGE = 0.5
# A model of at most this size is broadcast; an entry is a key and a ratio.
MODEL_BYTES, ENTRY_BYTES = 16 << 20, 12
# Texts of a block, for which a larger model is joined as one.
BLOCK_BYTES = 8 << 20
# What is on disk at a time: a larger model is made in so many slices, and asked in so many rounds of texts.
SLICES, ROUNDS = 4, 10
# Ranges of keys that a larger model is cut into: so many, and more where these would hold more entries than this.
RANGES, RANGE_ENTRIES = 1 << 7, 1 << 20

stored = partial(materialise, drop_shuffles=True)
# What a key is of.
PAIR, CONTEXT, WORD = (np.uint64(n) for n in (1, 2, 3))
# Sampled classes of the curve, and the columns of evidence.
NAMES = ["mean", *(f"top{n}" for n in STRETCHES)]


def fold_of(id_column: str) -> Column:
    return F.crc32(F.col(id_column).cast("string")) % FOLDS


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word before each word (32 bits, 0 at a text's start), the word (64 bits), and how many words each text has."""
    lowered = LOWER[data]
    starts, ends, counts = word_spans(lowered, offsets, IS_SYMBOL)
    words = span_hashes(lowered, starts, ends)
    before = np.zeros(len(words), np.int32)
    before[1:] = (words[:-1] >> np.uint64(32)).astype(np.uint32).view(np.int32)
    before[(np.cumsum(counts) - counts)[counts > 0]] = 0
    return before, words.view(np.int64), counts


def keys_of(before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of pairs, of the words before, and of words, in the model table."""
    left = mix64(before.astype(np.int64).view(np.uint64) * np.uint64(4) + CONTEXT)
    right = mix64(word.view(np.uint64) ^ WORD)
    return mix64((left ^ right) * np.uint64(5) + PAIR).view(np.int64), left.view(np.int64), right.view(np.int64)


def _distinct(*columns: np.ndarray) -> np.ndarray:
    """Places of one row of each combination of values."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for column in columns:
        held = column[order]
        new[1:] |= held[1:] != held[:-1]
    return order[new]


def _pair_rows(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each pair of words of each text, once, with one in the column of its class; equal pairs of a step are added up."""
    for batch in batches(table):
        labels = np.asarray(batch.column("toxic")).astype(np.int64)
        for lo, hi, data, offsets in text_steps(batch.column("text")):
            before, word, counts = words_of(data, offsets)
            text = np.repeat(np.arange(lo, hi), counts)
            once = _distinct(before, word, text)
            before, word, toxic = before[once], word[once], labels[text[once]]
            order = np.lexsort([before, word])
            first = np.flatnonzero(np.append(True, (np.diff(word[order]) != 0) | (np.diff(before[order]) != 0))[: len(order)])
            if len(first):
                n1 = np.add.reduceat(toxic[order], first)
                n0 = np.diff(np.append(first, len(order))) - n1
                columns = [before[order][first], word[order][first], n0, n1]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["before", "word", "n0", "n1"])


def _keyed(rows: DataFrame, kind: int) -> DataFrame:
    """(key, ratio) of (before, word, ratio) rows: 0 keys them as pairs, 1 as words before others, 2 as words."""

    def keyed(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            keys = keys_of(np.asarray(batch.column("before")), np.asarray(batch.column("word")))
            yield pa.RecordBatch.from_arrays([pa.array(keys[kind]), batch.column("ratio")], ["key", "ratio"])

    columns = [
        F.col(c).cast(k) if c in rows.columns else F.lit(0).cast(k).alias(c) for c, k in (("before", "int"), ("word", "bigint"))
    ]
    return rows.select(*columns, F.col("ratio").cast("float")).mapInArrow(keyed, "key bigint, ratio float")


def estimated_discounts(counts: DataFrame, names: list[str]) -> list[tuple[float, ...]]:
    """Discounts of counts of one, two and more in each of the columns, as modified Kneser-Ney
    smoothing takes them from how many counts are one, two, three and four.  Where these give none
    between nothing and the count itself, half the count."""
    often = [F.count(F.when(F.expr(n) == i, 1)) for n in names for i in (1, 2, 3, 4)]
    return [discounts_of(row) for row in np.reshape(counts.agg(*often).first(), (-1, 4)).tolist()]


def discounts_of(n: list[int]) -> tuple[float, ...]:
    ones, twos, *_ = n
    share = ones / max(ones + 2 * twos, 1)
    found = [i - (i + 1) * share * n[i] / max(n[i - 1], 1) for i in (1, 2, 3)]
    return tuple(float(d) if 0 < d < i and n[i - 1] and n[i] else i / 2 for i, d in enumerate(found, 1))


def _left(name: str, discounts: tuple[float, ...]) -> Column:
    """What is left of a count without its discount."""
    n = F.expr(name)
    return n - F.when(n >= 3, discounts[2]).when(n >= 2, discounts[1]).when(n >= 1, discounts[0]).otherwise(0.0)


def model_table(texts: DataFrame, pruned: bool = True) -> tuple[DataFrame, float]:
    """The two models as a table of (key, ratio), gathered from (text, toxic) rows by Spark, and the log ratio of
    words that are not in it.  A pair's ratio is that of its probabilities; that of a word before others
    holds for its other pairs, on top of the word's own."""
    pairs = texts.select("text", "toxic").mapInArrow(_pair_rows, "before int, word bigint, n0 bigint, n1 bigint")
    pairs = stored(pairs.groupBy("before", "word").agg(F.sum("n0").cast("int").alias("n0"), F.sum("n1").cast("int").alias("n1")), "toxic-pairs")
    sides = ["n0", "n1", "n0 + n1"]
    cuts = estimated_discounts(pairs, sides)
    known, contexts, held, own_words = pairs, pairs, F.lit(True), F.lit(True)
    if pruned:
        known, held, own_words = pairs.where("n1 > 0"), F.col("n1") > 0, F.col("k1") > 0
        contexts = lookup_join(pairs, materialise(known.select("before").distinct(), "toxic-contexts"), ["before"], "left_semi", row_bytes=48)
    # Words before others: all their counts, and what their pairs keep of these.
    contexts = contexts.groupBy("before").agg(
        *[F.sum(F.expr(n)).alias(f"t{c}") for c, n in enumerate(sides)],
        *[F.sum(F.when(held, _left(n, cut)).otherwise(0.0)).alias(f"u{c}") for c, (n, cut) in enumerate(zip(sides, cuts, strict=True))],
    )
    rest = [F.when(F.col(f"t{c}") > 0, 1 - F.col(f"u{c}") / F.col(f"t{c}")).otherwise(1.0).alias(f"l{c}") for c in range(3)]
    contexts = stored(contexts.select("before", "t0", "t1", "t2", *rest), "toxic-context-sums")
    k = [F.sum(F.when(F.col(f"n{c}") > 0, 1).otherwise(0)).alias(f"k{c}") for c in (0, 1)]
    counts = words = stored(pairs.groupBy("word").agg(*k, F.count("*").alias("k2")), "toxic-words")
    word_cuts = estimated_discounts(words, ["k0", "k1"])
    kept = [F.sum(F.when(own_words, _left(f"k{c}", word_cuts[c])).otherwise(0.0)) for c in (0, 1)]
    k0, k1, k2, u0, u1 = (float(v or 0) for v in words.agg(F.sum("k0"), F.sum("k1"), F.sum("k2"), *kept).first())
    totals, over = (max(k0, 1.0), max(k1, 1.0)), (1 - u0 / max(k0, 1.0), 1 - u1 / max(k1, 1.0))
    own = [
        (_left(f"k{c}", word_cuts[c]) / totals[c] + F.col("k2") * (over[c] / max(k2, 1.0))).alias(f"p{c}") for c in (0, 1)
    ]
    words = stored(words.where(own_words).select("word", *own), "toxic-word-shares")
    shared = _left("n0 + n1", cuts[2]) / F.col("t2")
    p = [
        F.when(F.col(f"t{c}") > 0, _left(f"n{c}", cuts[c]) / F.col(f"t{c}")).otherwise(0.0) + F.col(f"l{c}") * (shared + F.col("l2") * F.col(f"p{c}"))
        for c in (0, 1)
    ]
    slices = 1 if fits_broadcast(pairs, ENTRY_BYTES, MODEL_BYTES) else SLICES
    parts = [
        _keyed(contexts.select("before", F.log(F.col("l1") / F.col("l0")).alias("ratio")), 1),
        _keyed(words.select("word", F.log(F.col("p1") / F.col("p0")).alias("ratio")), 2),
    ]
    for i in range(slices):
        own = F.pmod(F.xxhash64("word"), F.lit(slices)) == i
        full = lookup_join(lookup_join(known.where(own), contexts, ["before"], row_bytes=96), words.where(own), ["word"], row_bytes=64)
        parts.append(_keyed(full.select("before", "word", F.log(p[1] / p[0]).alias("ratio")), 0))
    model = gathered([stored(part, "toxic-model") for part in parts])
    discard(pairs, contexts, counts, words)
    return model, float(np.log(over[1] / over[0])) if k0 and k1 else 0.0


class Found:
    """Entries of the model table, ready to be looked up."""

    def __init__(self, keys: np.ndarray, ratios: np.ndarray, other: float) -> None:
        order = slice(None) if (keys[1:] >= keys[:-1]).all() else np.argsort(keys)
        self.keys, self.ratios, self.other = keys[order], ratios[order], other

    def _of(self, wanted: np.ndarray, missing: float) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.full(len(wanted), missing), np.zeros(len(wanted), dtype=bool)
        # Sorted probes walk the keys in order.
        values, back = np.unique(wanted, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, values), len(self.keys) - 1)
        known = self.keys[at] == values
        return np.where(known, self.ratios[at], missing)[back], known[back]

    def log_ratios(self, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per word, the log of its probability under the toxic model less that under the ordinary one: by
        pairs, and by words alone."""
        pair_key, left_key, word_key = keys_of(before, word)
        alone, _ = self._of(word_key, self.other)
        pairs, known = self._of(pair_key, 0.0)
        return np.where(known, pairs, self._of(left_key, 0.0)[0] + alone), alone


def evidence(pairs: np.ndarray, alone: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text: the mean log ratio of its words by pairs, and that of its strongest stretch of each length by words."""
    out = np.zeros((len(counts), 1 + len(STRETCHES)))
    full = counts > 0
    if not full.any():
        return out
    n = counts[full]
    first = np.cumsum(n) - n
    out[full, 0] = np.add.reduceat(pairs, first) / n
    sums = np.concatenate([[0.0], np.cumsum(alone, dtype=np.float64)])
    for i, length in enumerate(STRETCHES):
        # Stretches that begin at each word; towards a text's end they begin earlier instead.
        at = np.minimum(np.arange(len(alone)), np.repeat(np.maximum(first + n - length, first), n))
        stop = np.minimum(at + length, np.repeat(first + n, n))
        out[full, 1 + i] = np.maximum.reduceat((sums[stop] - sums[at]) / (stop - at), first)
    return out


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression of weighted rows on standardised columns with a ridge, by damped Newton
    steps; the intercept comes last."""
    share = np.average(y, weights=weight)
    middle = np.average(x, axis=0, weights=weight)
    spread = np.sqrt(np.average((x - middle) ** 2, axis=0, weights=weight)) + 1e-9
    design = np.column_stack([(x - middle) / spread, np.ones(len(x))])
    beta = np.append(np.zeros(x.shape[1]), np.log(share / (1 - share)))
    ridge = np.append(np.full(x.shape[1], RIDGE), 0.0)

    def loss(b: np.ndarray) -> float:
        z = design @ b
        return weight @ (np.logaddexp(0, z) - y * z) + 0.5 * ridge @ b**2

    for _ in range(100):
        p = 1 / (1 + np.exp(-(design @ beta)))
        slope = design.T @ (weight * (y - p)) - ridge * beta
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(ridge + 1e-9)
        step = np.linalg.solve(bend, slope)
        now = loss(beta)
        while loss(beta + step) > now + 1e-12 * max(1.0, now) and np.abs(step).max() > 1e-9:
            step = step / 2
        beta = beta + step
        if np.abs(step).max() < 1e-7:
            break
    weights = beta[:-1] / spread
    return np.append(weights, beta[-1] - weights @ middle)


def _evidence_rows(batch: pa.RecordBatch, found: Found) -> Iterator[pa.RecordBatch]:
    for lo, hi, data, offsets in text_steps(batch.column("text")):
        before, word, counts = words_of(data, offsets)
        figures = evidence(*found.log_ratios(before, word), counts)
        columns = [batch.column(c).slice(lo, hi - lo) for c in ("row", "id")] + [pa.array(c) for c in figures.T]
        yield pa.RecordBatch.from_arrays(columns, ["row", "id", *NAMES])


def _by_broadcast(docs: DataFrame, model: DataFrame, other: float, schema: str) -> DataFrame:
    table = model.toArrow()
    sent = docs.sparkSession.sparkContext.broadcast(
        Found(np.asarray(table.column("key")), np.asarray(table.column("ratio")), other)
    )

    def rows(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            yield from _evidence_rows(batch, sent.value)

    found = materialise(docs.mapInArrow(rows, schema), "evidence")
    # The workers that later stages use need not keep the model.
    sent.destroy()
    return found


def _in_blocks(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the block they belong to, named after its first row."""
    block, size = None, 0
    for batch in batches(table):
        blocks = []
        for number, n in zip(batch.column("number").to_pylist(), batch.column("n_bytes").to_pylist(), strict=True):
            if block is None or size + n > BLOCK_BYTES:
                block, size = number, 0
            size += n
            blocks.append(block)
        kept = [c for c in batch.schema.names if c not in ("number", "n_bytes")]
        yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, pa.array(blocks, pa.int64())], [*kept, "block"])


def _once(keys: np.ndarray) -> np.ndarray:
    """The distinct keys, sorted."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]]


def _ranges_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """The ranges that keys fall into, as their highest bits tell."""
    return (keys.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _wanted_rows(table: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """The distinct keys that the texts of a block look up, a row for each range that holds any."""
    for batch in batches(table):
        blocks = np.asarray(batch.column("block"))
        cuts = np.concatenate([[0], np.flatnonzero(blocks[1:] != blocks[:-1]) + 1, [len(blocks)]])
        for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            texts = batch.column("text").slice(start, stop - start)
            found = [_once(np.concatenate(keys_of(*words_of(data, offsets)[:2]))) for _, _, data, offsets in text_steps(texts)]
            keys = _once(np.concatenate(found).view(np.uint64))
            held, first = np.unique(_ranges_of(keys, bits), return_index=True)
            cells = [part.tobytes() for part in np.split(keys, first[1:])][: len(held)]
            columns = [pa.array(np.full(len(held), blocks[start])), pa.array(held), pa.array(cells, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["place", "range", "keys"])


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _packed(model: DataFrame, bits: int) -> DataFrame:
    """The model as a row for each range: its entries side by side."""

    def pack(own: pa.Table) -> pa.Table:
        own = own.sort_by("key")
        keys, ratios = np.asarray(own.column("key")), np.asarray(own.column("ratio"))
        columns = [pa.array([v]) for v in (_ranges_of(keys[:1], bits)[0], keys.tobytes(), ratios.tobytes())]
        return pa.table(columns, ["range", "keys", "ratios"])

    ranged = model.withColumn("range", F.shiftrightunsigned("key", 64 - bits))
    slices = [ranged.where(F.col("range") % SLICES == i).groupBy("range") for i in range(SLICES)]
    return gathered([stored(s.applyInArrow(pack, "range bigint, keys binary, ratios binary"), "toxic-ranges") for s in slices])


def _answers(wanted: pa.Table, entries: pa.Table) -> pa.Table:
    """Of the keys that blocks want from a range, those the model has, with their ratios."""
    cells = wanted.column("keys").to_pylist()
    ends = np.cumsum([len(cell) // 8 for cell in cells], dtype=np.int64)[:-1]
    keys, own = _joined(wanted.column("keys"), np.int64), _joined(entries.column("keys"), np.int64)
    at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
    known = own[at] == keys if len(own) else np.zeros(len(keys), dtype=bool)
    ratios = _joined(entries.column("ratios"), np.float32)
    parts = list(zip(np.split(keys, ends), np.split(at, ends), np.split(known, ends), strict=True))[: len(cells)]
    found = [[k[n].tobytes() for k, _, n in parts], [ratios[i[n]].tobytes() for _, i, n in parts]]
    return pa.table([wanted.column("place"), *(pa.array(c, pa.binary()) for c in found)], ["place", "keys", "ratios"])


def _by_blocks(docs: DataFrame, model: DataFrame, other: float, schema: str) -> DataFrame:
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(RANGES, model.count() // RANGE_ENTRIES).bit_length() - 1
    ranges = _packed(model, bits)
    discard(model)

    def scored(own: pa.Table, entries: pa.Table) -> pa.Table:
        found = Found(_joined(entries.column("keys"), np.int64), _joined(entries.column("ratios"), np.float32), other)
        out = [part for batch in batches(own.to_batches()) for part in _evidence_rows(batch, found)]
        return pa.Table.from_batches(out)

    answer: Callable[[pa.Table, pa.Table], pa.Table] = _answers
    score: Callable[[pa.Table, pa.Table], pa.Table] = scored
    wanted_rows = partial(_wanted_rows, bits=bits)
    rounds = []
    for i in range(ROUNDS):
        own = docs.where(F.pmod(F.xxhash64("row", "id", "text"), F.lit(ROUNDS)) == i)
        # A task for each block; blocks in smaller tasks would share less.
        own = own.coalesce(max(1, size // (ROUNDS * BLOCK_BYTES)))
        numbered = own.withColumn("number", F.monotonically_increasing_id()).withColumn("n_bytes", F.octet_length("text"))
        texts = stored(numbered.mapInArrow(_in_blocks, f"{kinds}, block bigint"), "toxic-texts")
        wanted = texts.select("block", "text").mapInArrow(wanted_rows, "place bigint, range bigint, keys binary")
        held = wanted.groupBy("range").cogroup(ranges.groupBy("range")).applyInArrow(answer, "place bigint, keys binary, ratios binary")
        rounds.append(stored(texts.groupBy("block").cogroup(held.groupBy("place")).applyInArrow(score, schema), "evidence"))
        discard(texts)
    discard(ranges)
    return gathered(rounds)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    row_column: str | None = None,
    model_bytes: int = MODEL_BYTES,
    pruned: bool = False,
) -> DataFrame:
    """One row per document: id, held_out, score and predicted; with ``row_column``, a long, first that."""
    row = F.lit(None) if row_column is None else F.col(row_column)
    docs = docs.select(row.cast("long").alias("row"), F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("toxic")).dropna()
    known = known.where("toxic in (0, 1)").withColumn("fold", fold_of("id")).where("fold <> 0")
    known = materialise(known.groupBy("id", "fold").agg(F.max("toxic").alias("toxic")), "toxic-labels")
    learnt = docs.where((fold_of("id") != 0) & (fold_of("id") != FIT_FOLD))
    learnt = lookup_join(learnt, known.where(F.col("fold") != FIT_FOLD).select("id", "toxic"), ["id"], row_bytes=64)
    model, other = model_table(learnt, pruned)
    kind = docs.schema["id"].dataType.simpleString()
    schema = f"row bigint, id {kind}, {', '.join(f'{n} double' for n in NAMES)}"
    scored = _by_broadcast if model.count() * ENTRY_BYTES <= model_bytes else _by_blocks
    found = scored(docs, model, other, schema)
    fit = found.join(known.where(F.col("fold") == FIT_FOLD), "id").select("id", *NAMES, "toxic")
    order = F.xxhash64("id")
    sample = [
        r for c in (0, 1) for r in fit.where(F.col("toxic") == c).orderBy(order, "id").limit(FIT_ROWS).collect()
    ]
    shares = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2 or len({r["toxic"] for r in sample}) < 2:
        share = shares.get(1, 0) / max(sum(shares.values()), 1)
        beta = np.array([0.0] * len(NAMES) + [np.clip(np.log(max(share, 1e-13) / max(1 - share, 1e-13)), -30, 30)])
    else:
        x = np.array([[r[n] for n in NAMES] for r in sample])
        y = np.array([r["toxic"] for r in sample])
        totals = {r["toxic"]: r["n"] for r in fit.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        weight = np.array([totals[0], totals[1]])[y] / np.bincount(y)[y]
        beta = fit_curve(x, y.astype(float), weight)
    line = sum((F.col(n) * float(b) for n, b in zip(NAMES, beta[:-1], strict=True)), F.lit(float(beta[-1])))
    score = 1 / (1 + F.exp(-line))
    return found.select(
        *([] if row_column is None else [F.col("row").alias(row_column)]),
        F.col("id").alias(id_column),
        F.coalesce(fold_of("id") == 0, F.lit(False)).alias("held_out"),
        score.alias("score"),
        F.when(score >= 0.5, 1).otherwise(0).alias("predicted"),
    )
