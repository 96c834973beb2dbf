"""Balanced label propagation: linked documents move to their neighbours' shards under quotas.

Documents are linked when they share a group.  They start on shards by hash.  In each round
every group counts its members by shard and names the shard that holds most; members elsewhere
propose to move there.  Quotas decide how many may: as many as move the other way, and beyond
that what the shard has room for.  A small group moves as a whole, of a large one a part, chosen
by hash.  Only linked documents take part, as (row, group, shard); counts are aggregated before
they are shuffled, and the driver sees one number per pair of shards.

At last the law ``rows`` is made exact: every shard gets its share of rows, at most one apart.
Rows over a shard's share, unlinked ones first, fill the shares of others in order.  Rows are
numbered within a shard from counts per shard and bucket, so no shard passes through one task.

Nulls count as empty texts; an empty text is in no group.  Repeated rows are rows of their own and
copies of each other.  A null id is placed like any other.  Equal counts go to the shard that
a hash of the group prefers.  Very long texts only count by their size.  Extra columns are
ignored.  With fewer rows than shards some shards stay empty.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from firnspark.llm.common import text_or_empty
from firnspark.session import materialise

SHARDS = 24
ROUNDS = 5
SLACK = 0.05
# A group with more rows than SMALL and more than this share of a shard moves in parts.
WHOLE = 0.02
SMALL = 16
BUCKET_ROWS = 20_000
STEPS = 1 << 20


def quotas(wanted: np.ndarray, counts: np.ndarray, capacity: float) -> np.ndarray:
    """Share of the proposed moves (from, to) that may happen."""
    swaps = np.minimum(wanted, wanted.T)
    more = wanted - swaps
    room = np.maximum(capacity - counts, 0)
    total = more.sum(axis=0)
    extra = more * np.minimum(1, room / np.maximum(total, 1))
    return np.where(wanted > 0, (swaps + extra) / np.maximum(wanted, 1), 0)


def _cells(values: np.ndarray) -> Column:
    return F.array(*[F.lit(v.item()) for v in values])


def propagate(members: DataFrame, counts: np.ndarray, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """New shards of the linked rows: ``members`` has (row, grp, members, shard)."""
    capacity = (1 + SLACK) * counts.sum() / shards
    counts = counts.astype(float)
    for step in range(rounds):
        votes = members.groupBy("grp", "shard").agg(F.count("*").alias("n"))
        order = F.struct("n", F.xxhash64("grp", "shard"))
        goals = materialise(votes.groupBy("grp").agg(F.max_by("shard", order).alias("goal")), "shard-goals")
        proposed = materialise(members.join(goals, "grp"), "shard-proposals")
        wanted = np.zeros((shards, shards))
        for r in proposed.where("shard <> goal").groupBy("shard", "goal").count().collect():
            wanted[r["shard"], r["goal"]] = r["count"]
        if not wanted.any():
            break
        share = np.rint(quotas(wanted, counts, capacity) * STEPS).astype(np.int64)
        allowed = F.get(_cells(share.reshape(-1)), F.col("shard") * shards + F.col("goal"))
        whole = F.col("members") <= max(SMALL, WHOLE * capacity)
        dice = F.pmod(F.xxhash64(F.col("grp"), F.when(whole, F.lit(0)).otherwise(F.col("row")), F.lit(step)), F.lit(STEPS))
        moved = F.when((F.col("shard") != F.col("goal")) & (dice < allowed), F.col("goal")).otherwise(F.col("shard"))
        moved = proposed.withColumn("shard", moved).drop("goal")
        members = materialise(moved.select("row", "grp", "members", "shard"), "shard-members")
        for table, sign in ((members, 1), (proposed, -1)):
            for r in table.groupBy("shard").count().collect():
                counts[r["shard"]] += sign * r["count"]
    return members.select("row", "shard")


def exact_rows(placed: DataFrame, shards: int) -> DataFrame:
    """Rows (row, shard, linked) with their final shard and slot under the law ``rows``."""
    counts = np.zeros(shards, np.int64)
    for r in placed.groupBy("shard").count().collect():
        counts[r["shard"]] = r["count"]
    total = int(counts.sum())
    target = np.full(shards, total // shards)
    target[np.argsort(-counts, kind="stable")[: total % shards]] += 1
    kept = np.minimum(counts, target)
    over_before = np.cumsum(counts - kept) - (counts - kept)
    room_before = np.cumsum(target - kept) - (target - kept)

    buckets = total // BUCKET_ROWS + 1
    cell = (F.when(F.col("linked"), 0).otherwise(buckets) + F.pmod(F.xxhash64("row"), F.lit(buckets))).cast("long")
    placed = placed.withColumn("cell", cell)
    sizes = placed.groupBy("shard", "cell").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("shard").orderBy("cell")) - F.col("rows")
    sizes = materialise(sizes.select("shard", "cell", before.alias("before")), "shard-cells")
    within = Window.partitionBy("shard", "cell").orderBy("row")
    at = placed.withColumn("at", F.row_number().over(within) - 1).join(sizes, ["shard", "cell"])
    at = at.select("row", "shard", (F.col("before") + F.col("at")).alias("at"))
    own_kept = F.get(_cells(kept), F.col("shard"))
    spare = F.get(_cells(over_before), F.col("shard")) + F.col("at") - own_kept
    at = at.withColumn("spare", F.when(F.col("at") >= own_kept, spare))
    # The last shard whose room begins at or before the spare row's number, and has any.
    starts = _cells(room_before)
    open_ = F.array(*[F.lit(bool(r)) for r in (target - kept) > 0])
    taker = F.aggregate(
        F.sequence(F.lit(0), F.lit(shards - 1)), F.lit(-1),
        lambda best, s: F.when(F.get(open_, s) & (F.get(starts, s) <= F.col("spare")), s).otherwise(best),
    )
    at = at.withColumn("taker", F.when(F.col("spare").isNotNull(), taker))
    return at.select(
        "row",
        F.coalesce("taker", "shard").cast("int").alias("shard"),
        F.when(F.col("taker").isNull(), F.col("at"))
        .otherwise(F.get(_cells(kept), F.col("taker")) + F.col("spare") - F.get(starts, F.col("taker")))
        .cast("long").alias("slot"),
    )


def balanced_shards(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot and grown_shard (null).

    Documents with equal texts form a group; see ``propagate`` for groups of another kind.
    """
    text = text_or_empty(text_column)
    rows = docs.select(
        F.col(id_column).alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(text != "", F.substring(F.sha2(text, 256), 1, 32)).alias("grp"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("shard", F.pmod(F.xxhash64("id", "grp", "row"), F.lit(shards)).cast("int"))
    rows = materialise(rows, "shard-rows")
    shared = rows.where("grp is not null").groupBy("grp").agg(F.count("*").alias("members")).where("members > 1")
    members = rows.join(materialise(shared, "shard-groups"), "grp").select("row", "grp", "members", "shard")
    members = materialise(members, "shard-linked")
    counts = np.zeros(shards, np.int64)
    for r in rows.groupBy("shard").count().collect():
        counts[r["shard"]] = r["count"]
    moved = materialise(propagate(members, counts, shards).withColumnRenamed("shard", "new"), "shard-moved")
    placed = rows.select("row", "shard").join(moved, "row", "left").select(
        "row", F.coalesce("new", "shard").alias("shard"), F.col("new").isNotNull().alias("linked")
    )
    placed = materialise(placed, "shard-placed")
    final = exact_rows(placed, shards)
    return rows.select("row", "id", "size", "text_crc32").join(final, "row").select(
        F.col("id").alias(id_column), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
