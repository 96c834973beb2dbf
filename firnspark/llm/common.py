"""Helpers shared by the operators: numpy views of Arrow text, word hashes, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from firnspark.session import materialise

# Bytes of text that one numpy step works on; a longer text is a step of its own.
STEP_BYTES = 1 << 19

# The bytes that separate words (space and \t \n \v \f \r), and A-Z to a-z.
SPACES = b" \t\n\x0b\x0c\r"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True

_rng = np.random.default_rng(20240607)
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
WORD_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_steps(column: pa.Array, step: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of a text column as (first row, last row + 1, bytes, offsets).

    The bytes are a view of the Arrow buffer; offsets start at 0.  A null counts as empty.
    """
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.dtype(np.int64 if large else np.int32)
    _, at, data = column.buffers()
    if not len(column):
        return
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + step, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, whole[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def batches(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in table:
        if batch.num_rows:
            yield batch


# Separators for words of letters and digits: all ASCII bytes that are neither.
IS_SYMBOL = np.zeros(256, dtype=bool)
IS_SYMBOL[:128] = True
IS_SYMBOL[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def word_spans(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and how many words each text has."""
    wordy = ~separator[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[:1] = False
    before[1:] = wordy[:-1]
    starts = np.flatnonzero(wordy & (~before | cut[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1:] = False
    after[:-1] = wordy[1:]
    ends = np.flatnonzero(wordy & (~after | cut[1:])) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the given non-empty byte spans, which don't overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    rel = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), WORD_BASE, np.uint64))
    terms = BYTE_CODES[data[rel + np.repeat(starts, lengths)]] * powers[rel]
    return mix64(np.add.reduceat(terms, first) + lengths.astype(np.uint64))


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = IS_SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and how many words each text has."""
    lowered = LOWER[data]
    starts, ends, counts = word_spans(lowered, offsets, separator)
    return span_hashes(lowered, starts, ends), counts



def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of (a, b) edges: one row (id, component) per node, the
    component being its smallest node.

    Alternates large-star and small-star steps, which keep the components, until after a
    large-star step no node with a smaller neighbour has a second one or is one itself: the
    edges are then stars around the smallest nodes.  Nodes never meet on the driver; the minima
    are written before they are joined back, so AQE can split a node with many links.
    """
    edges = materialise(edges.where("a <> b").selectExpr("greatest(a, b) a", "least(a, b) b").distinct(), label)
    while True:
        # No step makes more rows than twice the edges.
        rows = 2 * edges.count()
        both = edges.unionByName(edges.selectExpr("b a", "a b"))
        low = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), label, rows=rows)
        large = both.join(low, "a").where("b > a").selectExpr("b a", "m b").where("a <> b").distinct()
        large = materialise(large, label, rows=rows)
        ends = large.unionByName(large.selectExpr("b a", "cast(null as bigint) b"))
        low = ends.groupBy("a").agg(F.min("b").alias("m"), F.count("b").alias("lower"), F.count_if(F.col("b").isNull()).alias("upper"))
        low = materialise(low, label, rows=rows)
        if low.where("lower > 1 or (lower = 1 and upper > 0)").isEmpty():
            edges = large
            break
        low = low.where("lower > 0").select("a", "m")
        small = large.join(low, "a").where("b <> m").selectExpr("b a", "m b")
        edges = materialise(small.unionByName(low.selectExpr("a", "m b")).distinct(), label, rows=rows)
    tops = edges.selectExpr("b id", "b component")
    return edges.selectExpr("a id", "b component").unionByName(tops).distinct()
