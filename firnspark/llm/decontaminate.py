"""Benchmark decontamination: pigeonhole edit matching with Myers' bit-parallel distance.

Texts and items are compared without case and with runs of white space as one blank.  An item
of n characters may occur with up to ``floor(ERROR_RATE * n)`` edits.  It is cut into one piece
more than that, so wherever it occurs at least one piece occurs unchanged: all pieces are found
in one pass of an automaton, and around each hit the smallest edit distance of the whole item to
any part of the text is worked out with Myers' bit vectors.

The benchmark goes to the tasks in blocks of at most ``BLOCK_CHARS`` characters, one pass over
the documents for each, so nothing larger than a block is ever broadcast.

Null and empty items, and items without a letter or digit, match nothing; an item so short that
it allows no edit must occur unchanged between word boundaries.  Null and empty texts hold nothing.
Repeated documents and items each give their rows.  Of equally good places the first is given.
Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from firnspark.llm.common import batches, text_or_empty

ERROR_RATE = 0.08
BLOCK_CHARS = 16 << 20

_BLANKS = re.compile(r"\s+")
_WORD = re.compile(r"\w")


def folded(text: str) -> str:
    """Lower case, character by character where that keeps the length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def plain(text: str) -> str:
    return " ".join(folded(text).split())


def original_places(text: str) -> list[int]:
    """Place in the text of every character of its plain form."""
    places: list[int] = []
    for word in re.finditer(r"\S+", text):
        if places:
            places.append(word.start() - 1)
        places.extend(range(word.start(), word.end()))
    return places


def budget(item: str, rate: float = ERROR_RATE) -> int:
    return int(rate * len(item))


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` consecutive pieces of nearly equal length, with their offsets."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def char_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    return dict(masks)


def best_end(masks: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """Smallest edit distance of the item to any part of ``text``, and where the first such part ends."""
    full = (1 << length) - 1
    top = 1 << (length - 1)
    plus, minus, score = full, 0, length
    best, end = length, 0
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (~(diagonal | plus) & full)
        down = diagonal & plus
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full
        plus = (down << 1 & full) | (~(diagonal | up) & full)
        minus = up & diagonal
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """The pieces of a block of items, ready to be looked for in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE) -> None:
        self.items, found = [], defaultdict(list)
        for item_id, text in items:
            text = plain(text or "")
            if not _WORD.search(text):
                continue
            errors = budget(text, rate)
            masks, back = char_masks(text), char_masks(text[::-1])
            for offset, piece in pieces(text, errors):
                found[piece].append((len(self.items), offset))
            self.items.append((item_id, text, errors, masks, back))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()
        self.empty = not found

    def windows(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """Per item, the disjoint stretches of the text where it may begin."""
        starts: dict[int, set[int]] = defaultdict(set)
        for end, (length, places) in self.automaton.iter(text):
            for item, offset in places:
                starts[item].add(end - length + 1 - offset)
        out = {}
        for item, at in starts.items():
            errors, merged = self.items[item][2], []
            for s in sorted(at):
                if merged and s - errors <= merged[-1][1] + errors:
                    merged[-1][1] = s
                else:
                    merged.append([s, s])
            out[item] = [(a - errors, b + errors) for a, b in merged]
        return out

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, stop) of the best place of each item in a plain text."""
        out = []
        for item, stretches in self.windows(text).items():
            item_id, wanted, errors, masks, back = self.items[item]
            best = None
            for a, b in stretches:
                lo, hi = max(a, 0), min(b + len(wanted) + errors, len(text))
                at = text.find(wanted, lo, hi)
                if errors == 0:
                    while at >= 0 and not self._bounded(text, at, at + len(wanted)):
                        at = text.find(wanted, at + 1, hi)
                if at >= 0:
                    best = (0, at, at + len(wanted))
                    break
                if errors == 0:
                    continue
                distance, end = best_end(masks, len(wanted), text[lo:hi])
                if distance <= errors and (best is None or distance < best[0]):
                    # The part that ends here begins where the reversed item ends in the reversed text.
                    first = max(lo, lo + end - len(wanted) - errors)
                    size = best_end(back, len(wanted), text[first : lo + end][::-1])[1]
                    best = (distance, lo + end - size, lo + end)
            if best:
                out.append((item_id, *best))
        return out

    @staticmethod
    def _bounded(text: str, start: int, stop: int) -> bool:
        before = start == 0 or not (text[start - 1].isalnum() and text[start].isalnum())
        return before and (stop == len(text) or not (text[stop].isalnum() and text[stop - 1].isalnum()))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    rate: float = ERROR_RATE,
) -> DataFrame:
    """One row per document and benchmark item found in it: id, item id, distance, and start and
    stop of the best place in code points of the text."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    items = benchmark.select(F.col(item_column).alias("item"), F.col("text")).where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 2 * (total // BLOCK_CHARS) + 1
    kinds = docs.schema["id"].dataType.simpleString(), items.schema["item"].dataType.simpleString()
    schema = f"id {kinds[0]}, item {kinds[1]}, distance int, start bigint, stop bigint"

    def search(block: int) -> DataFrame:
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        sent = spark.sparkContext.broadcast([(r["item"], r["text"]) for r in own])

        def rows(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value, rate)
            for batch in batches(table):
                found = []
                for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                    text = text.as_py()
                    hits = [] if matcher.empty else matcher.matches(plain(text))
                    if hits:
                        places, doc = original_places(text), doc.as_py()
                        found += [(doc, i, d, places[a], places[b - 1] + 1) for i, d, a, b in hits if b > a]
                columns = list(zip(*found, strict=True)) or [()] * 5
                types = [batch.schema.field(0).type, item_type, pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    ["id", "item", "distance", "start", "stop"],
                )

        return docs.mapInArrow(rows, schema)

    item_type = pa.int64() if kinds[1] == "bigint" else pa.int32() if kinds[1] == "int" else pa.string()
    found = search(0)
    for block in range(1, blocks):
        found = found.unionByName(search(block))
    return found.withColumnsRenamed({"id": id_column, "item": item_column})
