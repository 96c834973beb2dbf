"""Ranked lexical search the reversed way: the items' inverted index is broadcast, documents stream through it.

Terms are runs of letters, digits and characters beyond ASCII, A-Z lower-cased; they are compared as
they are, not by hashes.  One pass over the whole texts counts, of every document, all its terms and
how often it holds each term of the items; only these counts are written.  The number of documents,
the sum of their lengths and the document frequencies are aggregated from that table by Spark, and a
second pass over it adds up the integer scores and keeps the best documents of every item in a heap
of ``top`` entries.  The heaps of all tasks are merged in two steps.

The items' terms are handed out in blocks of about ``BLOCK_BYTES`` of text, one block after the
other, so neither driver nor broadcast grows with the items; frequencies always cover all documents.

Nulls and texts without terms: a document has no rank and counts for nothing, an item returns no
rows.  Equal rows of items count once; an item id on different texts gives each text a ranking of its
own.  Every document row ranks on its own, repeated ones too; of equal scores the smaller id comes
first, a null id last.  Without documents or items the result is empty.  Extra columns are ignored.
Very long texts are one array step each.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from firnspark.llm.common import IS_SYMBOL, LOWER, batches, text_or_empty, text_steps, word_spans
from firnspark.session import materialise

TOP = 10
# Text of the items whose inverted index is broadcast at once.
BLOCK_BYTES = 16 << 20
# Scores added up in one array step.
STEP_CELLS = 1 << 20
# First step of merging heaps: so many groups of tasks for every item.
MERGE_GROUPS = 64


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts as one binary array, and how many each text has."""
    lowered = LOWER[data]
    starts, ends, counts = word_spans(lowered, offsets, IS_SYMBOL)
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    held = lowered[~IS_SYMBOL[lowered]]
    buffers = [None, pa.py_buffer(at), pa.py_buffer(held)]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers), counts


def _item_terms(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, term, count) of every item."""
    for batch in batches(table):
        for lo, hi, data, offsets in text_steps(batch.column("text")):
            terms, counts = terms_of(data, offsets)
            item = batch.column("item").slice(lo, hi - lo).take(pa.array(np.repeat(np.arange(hi - lo), counts)))
            found = pa.table({"item": item, "term": terms}).group_by(["item", "term"]).aggregate([([], "count_all")])
            for part in found.rename_columns(["item", "term", "n"]).combine_chunks().to_batches():
                yield pa.RecordBatch.from_arrays(
                    [part.column("item"), part.column("term").cast(pa.binary()), part.column("n")], ["item", "term", "n"]
                )


class Index:
    """Inverted index of a block of items: the sorted terms, and of each term the items that hold it and how often."""

    def __init__(self, rows: pa.Table) -> None:
        self.terms = pc.unique(rows.column("term").combine_chunks().cast(pa.large_binary()))
        number = np.asarray(pc.index_in(rows.column("term").combine_chunks().cast(pa.large_binary()), self.terms)).astype(np.int64)
        order = np.argsort(number, kind="stable")
        self.items, slot = np.unique(np.asarray(rows.column("item")), return_inverse=True)
        self.slots, self.times = slot[order].astype(np.int64), np.asarray(rows.column("n"))[order].astype(np.int64)
        self.first = np.searchsorted(number[order], np.arange(len(self.terms) + 1))


def _counted(table: Iterator[pa.RecordBatch], terms: pa.Array) -> Iterator[pa.RecordBatch]:
    """Of every document with terms: how many it has, and how often each wanted one."""
    for batch in batches(table):
        for lo, hi, data, offsets in text_steps(batch.column("text")):
            words, counts = terms_of(data, offsets)
            found = np.asarray(pc.index_in(words, value_set=terms).fill_null(-1)).astype(np.int64)
            text = np.repeat(np.arange(hi - lo), counts)
            hit = found >= 0
            width = max(len(terms), 1)
            keys, often = np.unique(text[hit] * width + found[hit], return_counts=True)
            full = np.flatnonzero(counts > 0)
            cuts = np.append(np.searchsorted(keys, full * width), len(keys)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(lo, hi - lo).take(pa.array(full)),
                    pa.array(counts[full].astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array((keys % width).astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(often.astype(np.int64))),
                ],
                ["id", "n", "terms", "tf"],
            )


def weights_of(frequencies: np.ndarray, documents: int) -> np.ndarray:
    """Weight of every term from the number of documents that hold it."""
    return np.array(
        [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in frequencies], dtype=np.int64
    )


def length_norms(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The integer m of documents with n terms; in Python's integers, as the product may pass 64 bits."""
    values, at = np.unique(n, return_inverse=True)
    return np.array([25 + 75 * int(v) * documents // total for v in values], dtype=np.int64)[at]


class Heaps:
    """The best documents of every item of a block."""

    def __init__(self, index: Index, weights: np.ndarray, documents: int, total: int, top: int) -> None:
        self.index, self.weights, self.documents, self.total, self.top = index, weights, documents, total, top
        self.heaps: list[list[tuple[int, bool, int]]] = [[] for _ in index.items]
        # What a score must reach to enter a heap.
        self.least = np.ones(len(index.items), np.int64)

    def add(self, ids: np.ndarray, named: np.ndarray, n: np.ndarray, lengths: np.ndarray, terms: np.ndarray, tf: np.ndarray) -> None:
        """Documents with their numbers of terms, and one after the other the terms held and how often."""
        m = np.repeat(length_norms(n, self.documents, self.total), lengths)
        gain = self.weights[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        reach = self.index.first[terms + 1] - self.index.first[terms]
        doc = np.repeat(np.arange(len(ids)), lengths)
        # Documents of one step: bounded cells of the score matrix, and bounded postings.
        width = max(len(self.heaps), 1)
        cost = np.bincount(doc, weights=reach, minlength=len(ids)) + width
        step = (np.cumsum(cost) // STEP_CELLS).astype(np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(step[1:] != step[:-1]) + 1, [len(ids)]])
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            a, b = np.searchsorted(doc, [lo, hi])
            size = reach[a:b]
            base = np.cumsum(size) - size
            place = np.arange(int(size.sum())) - np.repeat(base - self.index.first[terms[a:b]], size)
            scores = np.zeros((hi - lo) * width, np.int64)
            cell = np.repeat(doc[a:b] - lo, size) * width + self.index.slots[place]
            np.add.at(scores, cell, np.repeat(gain[a:b], size) * self.index.times[place])
            self._enter(scores.reshape(hi - lo, width), ids[lo:hi], named[lo:hi])

    def _enter(self, scores: np.ndarray, ids: np.ndarray, named: np.ndarray) -> None:
        least = self.least
        if len(scores) > self.top:
            least = np.maximum(least, np.partition(scores, len(scores) - self.top, axis=0)[len(scores) - self.top])
        doc, item = np.nonzero(scores >= least)
        value = scores[doc, item]
        order = np.lexsort([ids[doc], ~named[doc], -value, item])
        item, doc, value = item[order], doc[order], value[order]
        # Only the first of an item's documents can enter its heap.
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        for i, d, v in zip(*(x[rank < self.top].tolist() for x in (item, doc, value)), strict=True):
            heap, entry = self.heaps[i], (v, bool(named[d]), -int(ids[d]))
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.top:
                self.least[i] = heap[0][0]

    def rows(self) -> pa.RecordBatch:
        held = [(int(self.index.items[i]), -d if named else None, v) for i, h in enumerate(self.heaps) for v, named, d in h]
        columns = list(zip(*held, strict=True)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "id", "score"])


def _best(rows: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def ranked(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``top`` documents of every item: item id, rank from 1, document id (a long) and score."""
    docs = docs.select(F.col(id_column).cast("long").alias("id"), text_or_empty(text_column).alias("text"))
    items = items.select(F.col(item_column).alias("name"), text_or_empty(text_column).alias("text")).distinct()
    items = materialise(items.withColumn("item", F.monotonically_increasing_id()), "items")
    blocks = int(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes + 1
    held = items.select("item", "text").mapInArrow(_item_terms, "item bigint, term binary, n bigint")
    held = materialise(held.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks))), "item-terms")
    found = None
    for block in range(blocks):
        part = _ranked_block(docs, Index(held.where(F.col("block") == block).select("item", "term", "n").toArrow()), top)
        # More than one block: written, so that only one index is alive at a time.
        part = materialise(part, "heaps") if blocks > 1 else part
        found = part if found is None else found.unionByName(part)
    found = _best(_best(found, ["item", "part"], top).drop("rank"), ["item"], top)
    return found.join(items.select("item", "name"), "item").select(
        F.col("name").alias(item_column), F.col("rank"), F.col("id").alias(id_column), "score"
    )


def _ranked_block(docs: DataFrame, index: Index, top: int) -> DataFrame:
    """The heaps of every task for one block of items."""
    spark = docs.sparkSession
    wanted = spark.sparkContext.broadcast(index.terms.to_pylist())

    def count(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counted(table, pa.array(wanted.value, pa.large_binary()))

    counts = materialise(docs.mapInArrow(count, "id bigint, n bigint, terms array<int>, tf array<bigint>"), "term-counts")
    wanted.destroy()
    documents, total = counts.agg(F.count("*"), F.sum("n")).first()
    # One row for each term of the block's items.
    often = np.zeros(len(index.terms), np.int64)
    for row in counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():
        often[row["term"]] = row["df"]
    sent = spark.sparkContext.broadcast((index, weights_of(often, documents), documents, int(total or 1)))

    def rank(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(*sent.value, top)
        for batch in batches(table):
            ids = batch.column("id")
            heaps.add(
                np.asarray(ids.fill_null(np.iinfo(np.int64).max)),
                np.asarray(ids.is_valid()),
                np.asarray(batch.column("n")),
                np.asarray(batch.column("terms").value_lengths()).astype(np.int64),
                np.asarray(batch.column("terms").flatten()).astype(np.int64),
                np.asarray(batch.column("tf").flatten()),
            )
        yield heaps.rows()

    rows = counts.mapInArrow(rank, "item bigint, id bigint, score bigint")
    return rows.withColumn("part", F.spark_partition_id() % MERGE_GROUPS)
