"""Repeated byte strings: per-shard suffix arrays, merged across shards.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else, in
the same document or another; strings are judged on the input.

1. Every window of ``LENGTH`` bytes is anchored at the smallest-hashed ``GRAM``-gram in it
   (leftmost on ties).  Equal windows have equal anchors, and two windows of one run around
   the same anchor are never equal.  So a window can repeat only if its anchor does, and
   runs whose anchor occurs once are settled by one aggregation.
2. Runs with the same bytes are counted by digest: where there are two, all their windows
   repeat, and only one of them goes on.
3. Anchors with differing runs are dealt to shards of about ``SHARD_BYTES``.  A shard sorts
   the suffixes of its runs by Larsson-Sadakane refinement and takes their common prefixes
   by Kasai's walk along the text, one lane per stretch; neighbours that share ``LENGTH``
   bytes repeat.
4. An anchor with more bytes than a shard is divided among several.  Each then hands on its
   distinct windows in order, cut into ranges, and every range is merged by binary search.

Nulls count as empty texts; texts shorter than ``LENGTH`` keep all bytes.  Rows may repeat
an id, or have none: they are told apart by id and text, and equal rows are copies of each
other.  Very long texts only make more runs.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from firnspark.llm.common import BYTE_CODES, batches, mix64, text_or_empty, text_steps
from firnspark.session import materialise

LENGTH = 200
GRAM = 32
GRAMS = LENGTH - GRAM + 1  # grams in a window
SHARD_BYTES = 1 << 20
LANE = 256
STEP = 1 << 18
# Low bits of the compared values hold the position, so that the leftmost of equal grams wins.
POSITION = np.uint64((1 << 31) - 1)
NO_ID = -(2**63)

_ODD = np.random.default_rng(200).integers(1, 2**63, 32, dtype=np.uint64) | np.uint64(1)


def block_hashes(codes: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """Hashes of all blocks of ``length`` bytes, by doubling."""
    level, have = codes, 1
    while have < length:
        more = min(have, length - have)
        level = (level[: len(level) - more] * _ODD[salt + have.bit_length()]) ^ (level[more:] >> np.uint64(7)) + level[more:]
        have += more
    return mix64(level)


def anchored_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same anchor: text number, start in the text, windows, anchor hash."""
    windows = len(data) - LENGTH + 1
    if windows <= 0:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing.view(np.uint64)
    grams = block_hashes(BYTE_CODES[data], GRAM)
    least = (grams & ~POSITION) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width < GRAMS:
        more = min(width, GRAMS - width)
        least = np.minimum(least[: len(least) - more], least[more:])
        width += more
    held = np.diff(offsets) >= LENGTH
    edges = np.zeros(windows + 1, np.int8)
    edges[offsets[:-1][held]] += 1
    edges[offsets[1:][held] - LENGTH + 1] -= 1
    inside = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    new = np.ones(windows, dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(new & inside)
    last = np.ones(windows, dtype=bool)
    last[:-1] = new[1:] | ~inside[1:]
    ends = np.flatnonzero(last & inside) + 1
    text = np.searchsorted(offsets, starts, side="right") - 1
    return text, starts - offsets[text], ends - starts, grams[(least[starts] & POSITION).astype(np.int64)]


def _run_rows(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(table):
        ids, digests = np.asarray(batch.column("id")), np.asarray(batch.column("td"))
        for lo, _, data, offsets in text_steps(batch.column("text"), STEP):
            text, start, windows, key = anchored_runs(data, offsets)
            if not len(text):
                continue
            view, digest = memoryview(data), xxhash.xxh3_64_intdigest
            first = offsets[text] + start
            spans = zip(first.tolist(), (first + windows + LENGTH - 1).tolist(), strict=True)
            own = np.fromiter((digest(view[a:b]) for a, b in spans), np.uint64, len(first))
            columns = [key.view(np.int64), own.view(np.int64), ids[lo + text], digests[lo + text]]
            columns += [start.astype(np.int32), windows.astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], ["key", "digest", "id", "td", "start", "windows"]
            )


def suffix_array(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Order of all suffixes of the concatenated pieces; a piece's end sorts before any byte,
    and ends sort by piece.

    Larsson-Sadakane: a suffix's rank is the place of its group; each round sorts only the
    suffixes of groups with several members, by the rank of what follows, twice as far on.
    """
    n, pieces = len(data), len(bounds) - 1
    piece = np.repeat(np.arange(pieces), np.diff(bounds))
    left = bounds[1:][piece] - np.arange(n)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    head = np.zeros(n, np.uint64)
    for j in range(8):
        head = (head << np.uint64(8)) | np.where(left > j, padded[j : j + n], np.uint64(0))
    order = np.argsort(head)
    rank = np.empty(n, np.int64)
    ends = (n + 1) * pieces  # room below all ranks for suffixes that end within reach, shorter ones first

    span = ends + n + 1

    def place(members: np.ndarray, at: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        """Rank sorted members by the first place of their group; which are still in groups of several."""
        heads = np.flatnonzero(fresh)
        sizes = np.diff(np.append(heads, len(members)))
        rank[members] = np.repeat(at[heads], sizes) + ends
        return np.repeat(sizes > 1, sizes)

    sorted_head = head[order]
    at = np.arange(n)
    open_ = place(order, at, np.concatenate([[True], sorted_head[1:] != sorted_head[:-1]]))
    far = 8
    while open_.any():
        members, at = order[at[open_]], at[open_]
        after = members + far
        inside = left[members] > far
        key = np.where(inside, rank[np.where(inside, after, 0)], left[members] * pieces + piece[members])
        group = rank[members]
        # Both in one number where it holds them, which sorts faster.
        turn = np.argsort((group - ends) * span + key) if n * span < 2**62 else np.lexsort((key, group))
        members, key, group = members[turn], key[turn], group[turn]
        order[at] = members
        open_ = place(members, at, np.concatenate([[True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])]))
        far *= 2
    return order


def common_prefixes(data: np.ndarray, bounds: np.ndarray, before: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Common prefix, up to LENGTH, of each window with the suffix before it in order.

    Kasai's walk: from one position to the next of the same piece the prefix shrinks by at
    most one byte.  Lanes walk stretches of at most LANE windows side by side, comparing
    eight bytes at a time.
    """
    n = len(data)
    end = np.repeat(bounds[1:], np.diff(bounds))
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)[: n + 8].copy().view("<u8").reshape(-1)
    prefix = np.zeros(n, np.int16)
    starts = [np.arange(a, a + w, LANE) for a, w in zip(bounds[:-1].tolist(), windows.tolist(), strict=True)]
    stops = np.repeat(bounds[:-1] + windows, [len(s) for s in starts])
    here = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    stops = np.minimum(stops, here + LANE)
    length = np.zeros(len(here), np.int64)
    while len(here):
        other = before[here]
        alone = other < 0
        other = np.where(alone, here, other)
        most = np.minimum(np.minimum(end[here] - here, end[other] - other), LENGTH)
        most[alone] = 0
        at = np.minimum(length, most)
        differ = words[here + at] ^ words[other + at]
        low = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, (np.bitwise_count(low - np.uint64(1)) >> 3).astype(np.int64))
        at = np.minimum(at + same, most)
        done = (same < 8) | (at >= most)
        prefix[here[done]] = at[done]
        length = np.where(done, np.maximum(at - 1, 0), at)
        here = here + done
        going = here < stops
        if not going.all():
            here, stops, length = here[going], stops[going], length[going]
    return prefix


def repeated_windows(data: np.ndarray, bounds: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which positions start a window that another position of the shard starts too, and the suffix order."""
    order = suffix_array(data, bounds)
    before = np.full(len(data), -1, np.int64)
    before[order[1:]] = order[:-1]
    prefix = common_prefixes(data, bounds, before, windows)
    hit = np.flatnonzero(prefix >= LENGTH)
    marked = np.zeros(len(data), dtype=bool)
    marked[hit] = True
    marked[before[hit]] = True
    return marked, order


SPAN_SCHEMA = "id bigint, td bigint, start int, stop int, bucket bigint, part int, sub int, h1 bigint, h2 bigint"


def _shard_rows(table: pa.Table) -> pa.Table:
    """Repeated spans of the runs of one shard, and its distinct windows if its anchor is divided."""
    table = table.combine_chunks()
    sizes = np.asarray(table["windows"]).astype(np.int64)
    pieces = table["content"].to_pylist()
    data = np.frombuffer(b"".join(pieces), np.uint8)
    bounds = np.concatenate([[0], np.cumsum(sizes + LENGTH - 1)])
    marked, order = repeated_windows(data, bounds, sizes)
    ids, digests, offset = (np.asarray(table[c]) for c in ("id", "td", "start"))
    flags = np.concatenate([marked, [False]]).astype(np.int8)
    edge = np.diff(np.concatenate([[0], flags]))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(bounds, starts, side="right") - 1
    once = np.asarray(table["copies"])[owner] == 1  # the others are covered as a whole
    starts, stops, owner = starts[once], stops[once], owner[once]
    base = offset[owner] - bounds[owner]
    spans = {
        "id": ids[owner], "td": digests[owner], "start": (starts + base).astype(np.int32),
        "stop": (stops + base + LENGTH - 1).astype(np.int32),
    }
    parts = int(table["parts"][0].as_py())
    found = pa.table(spans)
    for name, kind in (("bucket", pa.int64()), ("part", pa.int32()), ("sub", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())):
        found = found.append_column(name, pa.nulls(len(starts), kind))
    if parts <= 1:
        return found
    codes = BYTE_CODES[data]
    piece = np.repeat(np.arange(len(sizes)), np.diff(bounds))
    at = order[order - bounds[piece[order]] < sizes[piece[order]]]
    h1, h2 = block_hashes(codes, LENGTH)[at], block_hashes(codes, LENGTH, 16)[at]
    turn = np.lexsort((h2, h1))
    at, h1, h2 = at[turn], h1[turn], h2[turn]
    new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
    at, h1, h2 = at[new], h1[new], h2[new]
    owner = piece[at]
    place = (offset[owner] + at - bounds[owner]).astype(np.int32)
    part = ((h1 >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
    same = [np.full(len(at), table[c][0].as_py(), k) for c, k in (("bucket", np.int64), ("sub", np.int32))]
    columns = [ids[owner], digests[owner], place, (place + LENGTH).astype(np.int32), same[0], part, same[1]]
    columns += [h1.view(np.int64), h2.view(np.int64)]
    return pa.concat_tables([found, pa.table([pa.array(c) for c in columns], names=found.column_names)])


def _merge_rows(table: pa.Table) -> pa.Table:
    """Windows of one range that several shards hold: their ordered lists are merged by binary search."""
    keys = np.asarray(table["h1"]).view(np.uint64), np.asarray(table["h2"]).view(np.uint64)
    pairs = np.empty(table.num_rows, dtype=[("h1", np.uint64), ("h2", np.uint64)])
    pairs["h1"], pairs["h2"] = keys
    subs = np.asarray(table["sub"])
    found = np.zeros(len(pairs), dtype=bool)
    merged, rows = pairs[:0], np.zeros(0, np.int64)
    for sub in np.unique(subs):
        own = np.flatnonzero(subs == sub)
        own = own[np.lexsort((keys[1][own], keys[0][own]))]
        at = np.searchsorted(merged["h1"], keys[0][own])
        hit = np.zeros(len(own), dtype=bool)
        inside = at < len(merged)
        hit[inside] = merged[at[inside]] == pairs[own[inside]]
        found[own[hit]] = True
        found[rows[at[hit]]] = True
        merged = np.insert(merged, at[~hit], pairs[own[~hit]])
        rows = np.insert(rows, at[~hit], own[~hit])
    return table.filter(pa.array(found)).select(["id", "td", "start", "stop"])


def _content_rows(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(table):
        for row in range(batch.num_rows):
            text = batch.column("text")[row].as_buffer()
            view = memoryview(text)
            wanted = batch.column("wanted")[row].as_py()
            wanted = [w | {"content": bytes(view[w["start"] : w["start"] + w["windows"] + LENGTH - 1])} for w in wanted]
            out = pa.RecordBatch.from_pylist(wanted, schema=_CONTENT_ARROW)
            keys = [pa.array(np.full(len(wanted), batch.column(c)[row].as_py(), np.int64)) for c in ("id", "td")]
            yield pa.RecordBatch.from_arrays([*keys, *out.columns], ["id", "td", *out.schema.names])


_CONTENT_ARROW = pa.schema(
    [("bucket", pa.int64()), ("sub", pa.int32()), ("parts", pa.int32()), ("copies", pa.int64()),
     ("start", pa.int32()), ("windows", pa.int32()), ("content", pa.binary())]
)
_CONTENT = "id bigint, td bigint, bucket bigint, sub int, parts int, copies bigint, start int, windows int, content binary"


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The documents with the two keys that tell rows apart."""
    text = text_or_empty(text_column)
    return docs.select(
        "*", F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_td"),
        text.alias("_text"),
    )


def repeated_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row with something to remove: id (NO_ID for null), td and its spans [start, stop) in
    bytes, which may overlap.  The spans of one row are one list, bounded by its length."""
    base = keyed(docs, id_column, text_column).select(
        F.col("_id").alias("id"), F.col("_td").alias("td"), F.col("_text").alias("text")
    )
    schema = "key bigint, digest bigint, id bigint, td bigint, start int, windows int"
    runs = materialise(base.mapInArrow(_run_rows, schema), "runs")
    often = materialise(runs.groupBy("key").count().where("count > 1").select("key"), "run-keys")
    runs = materialise(runs.join(often, "key", "left_semi"), "run-candidates")
    one = runs.groupBy("key", "digest").agg(
        F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("id", "td", "start", "windows")]
    )
    one = materialise(one, "run-classes")
    whole = runs.join(one.where("copies > 1").select("key", "digest"), ["key", "digest"], "left_semi")
    spans = whole.selectExpr("id", "td", "start", f"start + windows + {LENGTH - 1} stop")

    size = F.sum(F.col("windows") + LENGTH - 1)
    mixed = one.groupBy("key").agg(F.count("*").alias("variants"), size.alias("bytes")).where("variants > 1")
    mixed = materialise(mixed.select("key", "bytes"), "run-mixed")
    total = mixed.agg(F.sum("bytes")).first()[0] or 0
    shards = -(-total // SHARD_BYTES) or 1
    parts = F.ceil(F.col("bytes") / SHARD_BYTES).cast("int")
    sub = F.when(parts > 1, F.pmod("digest", parts)).otherwise(-1).cast("int")
    bucket = F.when(parts > 1, F.col("key")).otherwise(F.pmod("key", F.lit(shards)))
    dealt = one.join(mixed, "key").select(
        "id", "td", F.struct(bucket.alias("bucket"), sub.alias("sub"), parts.alias("parts"), "copies", "start", "windows").alias("w")
    )
    wanted = materialise(dealt.groupBy("id", "td").agg(F.collect_list("w").alias("wanted")), "run-wanted")
    content = base.join(wanted, ["id", "td"])
    content = content.mapInArrow(_content_rows, _CONTENT)
    sorted_ = materialise(content.groupBy("bucket", "sub").applyInArrow(_shard_rows, SPAN_SCHEMA), "shard-spans")
    ranges = sorted_.where("part is not null").groupBy("bucket", "part")
    merged = ranges.applyInArrow(_merge_rows, "id bigint, td bigint, start int, stop int")
    spans = spans.unionByName(sorted_.where("part is null").select("id", "td", "start", "stop")).unionByName(merged)
    return spans.groupBy("id", "td").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def joined_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans."""
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["stop"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


def _result_rows(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(table):
        found = {name: [] for name in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")}
        for text, spans in zip(batch.column("_text"), batch.column("spans"), strict=True):
            text = text.as_buffer().to_pybytes()
            spans = joined_spans(spans.as_py())
            kept = kept_bytes(text, spans)
            found["n_bytes"].append(len(text))
            found["n_removed"].append(len(text) - len(kept))
            found["n_spans"].append(len(spans))
            found["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            # A cut may split a character; its remaining bytes go from the text.
            found["kept_text"].append(kept.decode("utf-8", "ignore"))
        rest = batch.schema.names[:-2]
        columns = [batch.column(c) for c in rest] + [
            pa.array(v, pa.string() if k.startswith("kept") else pa.int64()) for k, v in found.items()
        ]
        yield pa.RecordBatch.from_arrays(columns, [*rest, *found])


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, the columns of ``keep``, n_bytes, n_removed, n_spans, kept_sha256
    of the remaining bytes and kept_text, the whole characters among them."""
    spans = materialise(repeated_spans(docs, id_column, text_column), "spans")
    base = keyed(docs, id_column, text_column).select(id_column, *keep, "_id", "_td", "_text")
    rows = base.join(spans.withColumnsRenamed({"id": "_id", "td": "_td"}), ["_id", "_td"], "left")
    rows = rows.select(id_column, *keep, "_text", "spans")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-2])
    return rows.mapInArrow(
        _result_rows,
        f"{fields}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string",
    )
