"""Conflict-constrained best-fit packing of documents into sequences of a fixed length.

A document takes its words plus one end mark.  What exceeds the capacity is cut into pieces
that fill a bin each; the rest is packed best-fit, largest first: among the open bins in order
of what they have left, the search starts at the tightest that is large enough and goes on to
its successors until one is compatible.  Every bin carries a bitmap of its sources and one of
its duplicate clusters; a piece is compatible if neither bitmap has its bit.  Without a
compatible bin a new one is opened.

Documents are dealt by a hash of their row number to shards of about ``SHARD_ROWS`` pieces, which are packed side
by side; a bin never spans shards.  Only ids, sizes, source and cluster travel, never texts.

Null and empty texts take one place, the end mark, and belong to no cluster.  A null source or
cluster conflicts with nothing.  Ties go by id and piece; the tightest bin opened first wins.
Repeated rows are packed as often as they occur.  Very long texts become many pieces.  Extra
columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from firnspark.llm.common import text_or_empty

CAPACITY = 2048
SHARD_ROWS = 8192


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(r"\S+"))


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> tuple[list[int], list[int]]:
    """Bin of each piece, and how full each bin is; pieces are taken in the given order."""
    bits: tuple[dict, dict] = ({}, {})
    open_: list[tuple[int, int]] = []  # what is left, bin; in order
    held: list[tuple[int, int]] = []  # sources and clusters by bin
    left: list[int] = []
    chosen = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        masks = [0 if v is None else 1 << b.setdefault(v, len(b)) for v, b in zip((source, cluster), bits, strict=True)]
        at = bisect_left(open_, (size, -1))
        while at < len(open_):
            own = held[open_[at][1]]
            if not (own[0] & masks[0] or own[1] & masks[1]):
                break
            at += 1
        if at < len(open_):
            _, bin_ = open_.pop(at)
            held[bin_] = held[bin_][0] | masks[0], held[bin_][1] | masks[1]
            left[bin_] -= size
        else:
            bin_ = len(held)
            held.append((masks[0], masks[1]))
            left.append(capacity - size)
        if left[bin_]:
            insort(open_, (left[bin_], bin_))
        chosen.append(bin_)
    return chosen, [capacity - rest for rest in left]


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    size: Column | None = None,
    source: Column | None = None,
    cluster: Column | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece: id, piece, first_word, size, source, cluster, shard, bin and the bin's fill.

    ``size`` counts the words of a document (by default of ``text``), ``source`` and ``cluster``
    name what may not meet in a bin (by default ``source`` and the digest of an equal text).
    """
    text = text_or_empty()
    size = word_count() if size is None else size
    source = F.col("source").cast("string") if source is None else source
    cluster = F.when(text != "", F.xxhash64(text)) if cluster is None else cluster
    items = docs.select(
        F.col(id_column).alias("id"), (F.coalesce(size, F.lit(0)) + 1).cast("long").alias("total"),
        source.alias("source"), cluster.alias("cluster"), F.xxhash64(F.monotonically_increasing_id()).alias("dealt"),
    )
    pieces = items.agg(F.sum(F.ceil(F.col("total") / capacity))).first()[0] or 0
    # A place at each multiple of the capacity; the last piece is what is left.
    items = items.withColumn("first_word", F.explode(F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(capacity).cast("long"))))
    items = items.withColumn("size", F.least(F.lit(capacity), F.col("total") - F.col("first_word")))
    items = items.withColumn("piece", (F.col("first_word") / capacity).cast("long"))
    shards = -(-int(pieces) // SHARD_ROWS) or 1
    items = items.withColumn("shard", F.pmod("dealt", F.lit(shards))).drop("total", "dealt")
    kind = items.schema["id"].dataType.simpleString()
    cluster_kind = items.schema["cluster"].dataType
    # As a string: pandas would round a long beside nulls.
    items = items.withColumn("cluster", F.col("cluster").cast("string"))

    def one_shard(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "id", "piece", "cluster"], ascending=[False, True, True, True], kind="stable")
        sources = [None if pd.isna(v) else v for v in rows["source"]]
        clusters = [None if pd.isna(v) else v for v in rows["cluster"]]
        chosen, fill = best_fit(rows["size"].tolist(), sources, clusters, capacity)
        return rows.assign(bin=chosen, fill=[fill[b] for b in chosen])[
            ["id", "piece", "first_word", "size", "source", "cluster", "shard", "bin", "fill"]
        ]

    packed = items.groupBy("shard").applyInPandas(
        one_shard,
        f"id {kind}, piece long, first_word long, size long, source string, cluster string, shard long, bin long, fill long",
    )
    return packed.withColumn("cluster", F.col("cluster").cast(cluster_kind)).withColumnRenamed("id", id_column)
