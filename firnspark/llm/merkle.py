"""Document fingerprints: a Merkle tree over paragraphs and sections.

Sections are separated by an empty line, paragraphs by a line break.  A paragraph's node is the
SHA-256 of its text, a section's that of its paragraphs' nodes, the root that of the sections'
nodes.  The root is the fingerprint: equal texts have equal roots, and cutting loses no
character, so different texts have different ones.  Where roots differ, the first differing
section and paragraph locate an edit, and the likeness is the share of leaves in common, leaves
being the sentences of the paragraphs: ``2 * common / (leaves + leaves)``, over distinct leaves.
Everything is DataFrame and SQL functions.

``edited_fingerprints`` compares each document with an edited text and with its neighbour in
descending order of id.  The order is found by a range partition over ids alone; the texts are
shuffled once by id, and a neighbour hands on no more than the head that is pasted and its leaf
hashes.

Nulls count as empty texts, whose tree is one empty paragraph.  A null id comes last.  Rows that
repeat an id and text are one document and get equal rows; rows that repeat an id with another
text follow by a hash of it.  A single document is its own neighbour.  Very long texts only
have more nodes.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from firnspark.llm.common import text_or_empty
from firnspark.session import materialise

NO_ID = -(2**63)
# Leaves end with a stop before a blank or tab, or with their paragraph.
LEAF_CUT = r"(?<=[.!?])(?=[ \t])|\n"


def sections(text: str) -> str:
    """SQL for the nodes of the sections and paragraphs: array<struct<node, paragraphs>>."""
    paragraphs = "transform(split(s, '\\n'), p -> sha2(p, 256))"
    return (
        f"transform(transform(split({text}, '\\n\\n'), s -> {paragraphs}), "
        "n -> struct(sha2(array_join(n, ''), 256) as node, n as paragraphs))"
    )


def root(tree: str) -> str:
    """SQL for the root; the count of children keeps levels apart."""
    return f"sha2(concat(size({tree}), ':', array_join(transform({tree}, t -> t.node), '')), 256)"


def leaves(text: str) -> str:
    return f"array_distinct(transform(split({text}, r'{LEAF_CUT}'), l -> xxhash64(l)))"


def likeness(a: str, b: str) -> str:
    return f"2.0D * size(array_intersect({a}, {b})) / (size({a}) + size({b}))"


def first_difference(a: str, b: str) -> str:
    """SQL for the number of the first element that differs (from 0), null if there is none."""
    differs = f"transform(sequence(0, greatest(size({a}), size({b})) - 1), i -> not (get({a}, i) <=> get({b}, i)))"
    return f"nullif(array_position({differs}, true), 0) - 1"


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, fingerprint and the tree's sections with their paragraphs' nodes."""
    base = docs.select(id_column, text_or_empty(text_column).alias("text"))
    tree = base.select(id_column, F.expr(sections("text")).alias("sections"))
    return tree.select(id_column, F.expr(root("sections")).alias("fingerprint"), "sections")


def neighbours(keys: DataFrame) -> DataFrame:
    """For each (id, td, n) the document before it in descending order of id, round the end:
    id, td, prev_id, prev_td, prev_n."""
    ordered = keys.distinct().repartitionByRange(F.col("id").desc(), F.col("td"))
    ordered = materialise(ordered.withColumn("part", F.spark_partition_id()), "order-parts")
    sizes = ordered.groupBy("part").agg(F.count("*").alias("rows"))  # one row per range
    before = F.sum("rows").over(Window.orderBy("part")) - F.col("rows")
    sizes = sizes.withColumn("before", before)
    within = Window.partitionBy("part").orderBy(F.col("id").desc(), F.col("td"))
    at = F.row_number().over(within) - 1
    numbered = ordered.withColumn("at", at).join(F.broadcast(sizes), "part")  # as many rows as ranges
    numbered = materialise(numbered.select("id", "td", "n", (F.col("before") + F.col("at")).alias("at")), "order")
    total = numbered.count()
    prev = numbered.select(
        *[F.col(c).alias(f"prev_{c}") for c in ("id", "td", "n")], F.pmod(F.col("at") + 1, F.lit(max(total, 1))).alias("at")
    )
    return numbered.join(prev, "at").select("id", "td", "prev_id", "prev_td", "prev_n")


def edited_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, and the first section and paragraph in which the edited text differs.

    The edited text has the document's last third, rounded down, replaced by as much of the head
    of the next document, which is the one with the next smaller id.
    """
    text = text_or_empty(text_column)
    keyed = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("td"), text.alias("text")
    )
    order = materialise(neighbours(keyed.select("id", "td", F.length("text").alias("n"))), "neighbours")
    given = keyed.join(order, ["id", "td"]).select(
        F.col("prev_id").alias("id"),
        F.col("prev_td").alias("td"),
        F.expr("substring(text, 1, prev_n div 3)").alias("head"),
        F.expr(leaves("text")).alias("next_leaves"),
    )
    given = given.groupBy("id", "td").agg(F.first("head").alias("head"), F.first("next_leaves").alias("next_leaves"))
    both = keyed.join(given, ["id", "td"]).withColumn("n", F.length("text"))
    both = both.withColumn("edited", F.expr("concat(substring(text, 1, n - n div 3), head)"))
    trees = both.select(
        "id", "n", F.sha2("edited", 256).alias("edited_sha256"), "next_leaves",
        F.expr(sections("text")).alias("tree"), F.expr(sections("edited")).alias("new_tree"),
        F.expr(leaves("text")).alias("own"), F.expr(leaves("edited")).alias("new"),
    )
    section = F.expr(first_difference("tree.node", "new_tree.node"))
    trees = trees.withColumn("edit_section", section)
    paragraph = first_difference("get(tree, edit_section).paragraphs", "get(new_tree, edit_section).paragraphs")
    return trees.select(
        F.nullif("id", F.lit(NO_ID)).cast(docs.schema[id_column].dataType).alias(id_column),
        F.col("n").cast("long").alias("n_chars"),
        "edited_sha256",
        F.expr(root("tree")).alias("fingerprint"),
        F.expr(root("new_tree")).alias("edited_fingerprint"),
        F.expr(likeness("own", "new")).alias("near_edited"),
        F.expr(likeness("own", "next_leaves")).alias("near_next"),
        F.col("edit_section").cast("long").alias("edit_section"),
        F.expr(f"case when edit_section is not null and edit_section < least(size(tree), size(new_tree)) then {paragraph} end")
        .cast("long").alias("edit_paragraph"),
    )
