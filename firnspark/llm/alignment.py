"""Alignment of two tokenizers' tokens over the same bytes, with whitespace-token anchors.

A text is cut at every single space between two characters that are not blanks.  Both tokenizers have a
token that begins there: the byte-level split begins one at such a space, whatever stands around it, and no
piece has a space behind another character, so no merge crosses it.  So the tokens of a text are those of its
windows, which are mostly single words, and the tokens of a window and their alignment depend on the window alone.
They are kept by the window's text and looked up the next time.  Within a window, ends that both sides share cut
the tokens into groups, and every stretch between neighbouring ends of either side is one linked pair of tokens.
With a piece model of another kind, a text is one window.

How many documents hold a pair of ids linked is counted by Spark over the whole corpus, in a table
that is never on the driver.  For the sums over a document's links, documents are taken together in
blocks of about ``BLOCK_BYTES`` of text; the distinct pairs of a block are joined with the table and
meet the block's documents in one task.  So a pair that every document holds is one row a block.

A text that is null or empty, or that a tokenizer does not give back byte for byte, has no tokens: all
its figures are 0 and ``groups`` is ''.  Repeated rows and null ids are rows of their own.  Without
rows the result is empty.  Extra columns are ignored.  A very long text is a block of its own.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from firnspark.llm.common import batches, text_or_empty
from firnspark.session import materialise

# Where the vocabulary files lie on every executor.
BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_BYTES = 4 << 20
# Texts tokenised together: at most so many bytes, but for a longer text.
STEP_BYTES = 1 << 19
# Alignments kept by a task, in two halves of which the older one goes, as do windows of more characters; a half
# has so many linked pairs for each of its windows at most.
MEMO_WINDOWS = 1 << 18
MEMO_LETTERS = 96
MEMO_PAIRS = 16
# Fixed value: how byte-level vocabularies split a text before the merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A run of blanks that is too long for the split's look-ahead.
BLANKS = 50_000
BLANK_RUN = re.compile(rf"\s{{{BLANKS}}}")
# Windows tokenised together.
JOINED = 512
# Where texts are cut into windows.
CUT = re.compile(r"(?<=\S) (?=\S)")
# A pair of ids is one number.
SIDE = 1 << 20


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves,
    the others for the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Byte-level tokens: their ids for texts, and the bytes of every id.  The vocabulary's ids are in the order
    of its merges, so they serve as ranks; strings of special tokens are plain text.  Texts with a very long run of
    blanks, for which the faster encoder has no room, are left to the library the file was written for."""

    def __init__(self, path: str) -> None:
        import tiktoken

        letters = byte_letters()
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            if all(c in letters for c in token):
                self.bytes[number] = bytes(letters[c] for c in token)
        ranks = {token: number for number, token in enumerate(self.bytes) if token}
        self.encoding = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.path, self.tokenizer = path, None

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._with_blanks(t) if len(t) > BLANKS and BLANK_RUN.search(t) else self.encoding.encode_ordinary(t) for t in texts]

    def _with_blanks(self, text: str) -> list[int]:
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
            self.tokenizer.encode_special_tokens = True
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class Pieces:
    """Tokens of a piece model with byte fallback; it puts a space before a text by itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        # Whether words are tokenised apart: by merges, whose scores are ranks, none of which crosses a space.
        self.apart = True
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            self.apart &= self.model.get_score(number).is_integer() and "▁" not in piece.lstrip("▁")
            if self.model.is_byte(number):
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif self.model.is_control(number) or self.model.is_unknown(number):
                self.bytes.append(b"")
            else:
                self.bytes.append(piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


# Of windows: their groups as text, their numbers of tokens of both sides, of groups and of linked pairs, and
# the linked pairs of one window after the other as 64-bit numbers.
Aligned = tuple[list[str], np.ndarray, np.ndarray]


def windows_of(text: str) -> list[str]:
    """The windows of a text."""
    words = text.split()
    return words if " ".join(words) == text else CUT.split(text)


class Side:
    """What aligning needs of a vocabulary's ids: their lengths."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.lengths = np.array([len(x) for x in tokens], np.int64)


def aligned_windows(ids: list[np.ndarray], counts: np.ndarray, a: Side, b: Side, names: list[str]) -> Aligned:
    """The alignment of each window from the ids of both sides, and how many of them each window has.  Every stretch
    between neighbouring ends of either side lies in one token of each side, and in no two the same.  ``names`` holds A's ids
    behind a line's end, which begins a window, ';' and ',' and then B's behind '|' and ','."""
    ids_a, ids_b = ids
    last_a = np.cumsum(counts[0])
    # Both sides of a window have as many bytes, so ends in the whole sequence can be compared.
    ends_a, ends_b = np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b])
    ends = np.concatenate([ends_a, ends_b])
    ends.sort(kind="stable")
    ends = ends[np.append(True, ends[1:] != ends[:-1])]
    in_a, in_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    pairs = ids_a[in_a] * SIDE + ids_b[in_b]
    links = np.diff(np.searchsorted(ends, ends_a[last_a - 1], side="right"), prepend=0)
    shared = ends[(ends_a[in_a] == ends) & (ends_b[in_b] == ends)]
    groups = np.diff(np.searchsorted(shared, ends_a[last_a - 1], side="right"), prepend=0)
    # Tokens in the order of the text: a group's A side, then its B side.
    of_a, of_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
    first_a, first_b = (np.searchsorted(of, np.arange(len(shared) + 1)) for of in (of_a, of_b))
    n_a, n_b, place = len(a.lengths), len(b.lengths), np.empty(len(ids_a) + len(ids_b), np.int64)
    here = np.where(np.arange(len(ids_a)) == first_a[of_a], 1, 2)
    here[np.append(0, last_a[:-1])] = 0
    place[np.arange(len(ids_a)) + first_b[of_a]] = ids_a + here * n_a
    here = np.where(np.arange(len(ids_b)) == first_b[of_b], 0, 1)
    place[np.arange(len(ids_b)) + first_a[of_b + 1]] = ids_b + 3 * n_a + here * n_b
    return "".join(map(names.__getitem__, place.tolist())).split("\n")[1:], np.stack([*counts, groups, links]), pairs


def _picked(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of stretches, one stretch after the other."""
    last = np.cumsum(sizes)
    return np.repeat(firsts - (last - sizes), sizes) + np.arange(last[-1] if len(last) else 0)


class Numbers(dict[str, int]):
    """A number for each window asked for, that of ``older`` if it has one; those without are listed in ``new``."""

    def __init__(self, older: dict[str, int]) -> None:
        self.older, self.next, self.new = older, len(older), []

    def __missing__(self, key: str) -> int:
        number = self.older.get(key)
        if number is None:
            number = self.next
            self.next += 1
            self.new.append(key)
        self[key] = number
        return number


class Aligner:
    """Aligns the tokens of texts; windows met before are looked up."""

    def __init__(self, a: ByteLevel, b: Pieces) -> None:
        self.a, self.b = a, b
        self.sides = Side(a.bytes), Side(b.bytes)
        self.names = [f"{before}{i}" for before in "\n;," for i in range(len(a.bytes))]
        self.names += [f"{before}{i}" for before in "|," for i in range(len(b.bytes))]
        # Numbers of windows by their text.
        self.older: dict[str, int] = {}
        self.memo = Numbers(self.older)
        # By number: the alignments, and where the pairs of each begin.
        self.strings: list[str] = []
        self._hold(np.zeros((4, 0), np.int64), np.zeros(0, np.int64))

    def _hold(self, figures: np.ndarray, pairs: np.ndarray) -> None:
        self.figures, self.pairs, self.begins = figures, pairs, np.cumsum(figures[3]) - figures[3]

    def _learn(self, windows: list[str]) -> None:
        """Align new windows.  One that a tokenizer does not give back has no tokens."""
        # Those that neither begin nor end with a blank can be tokenised as one text.
        plain = [self.b.apart and not (w[0].isspace() or w[-1].isspace()) for w in windows]
        joined = [w for w, p in zip(windows, plain, strict=True) if p]
        parts = [(np.flatnonzero(plain), self._tokens_joined(joined))] if joined else []
        if parts and parts[0][1] is None:
            parts, plain = [], [False] * len(windows)
        parts += [(np.array([i]), own) for i, p in enumerate(plain) if not p and (own := self._tokens(windows[i]))]
        figures, pairs, strings = np.zeros((4, len(windows)), np.int64), self.pairs[:0], [""] * len(windows)
        if parts:
            order = np.concatenate([at for at, _ in parts])
            ids = [np.concatenate([own[0][i] for _, own in parts]) for i in range(2)]
            counts = np.concatenate([own[1] for _, own in parts], axis=1)
            own, found, own_pairs = aligned_windows(ids, counts, *self.sides, self.names)
            # In the order of the windows.
            sorted_, figures[:, order] = np.argsort(order), found
            pairs = own_pairs[_picked((np.cumsum(found[3]) - found[3])[sorted_], found[3][sorted_])]
            for at, string in zip(order.tolist(), own, strict=True):
                strings[at] = string
        self.strings += strings
        self._hold(np.concatenate([self.figures, figures], axis=1), np.concatenate([self.pairs, pairs]))

    def _tokens(self, window: str) -> tuple[list[np.ndarray], np.ndarray] | None:
        """The ids of both sides of a window and how many these are, or None."""
        ids = self.a.encode([" " + window])[0], self.b.encode([window])[0]
        whole = (" " + window).encode()
        if any(b"".join(map(side.bytes.__getitem__, x)) != whole for side, x in zip((self.a, self.b), ids, strict=True)):
            return None
        return [np.array(x, np.int64) for x in ids], np.array([[len(x)] for x in ids])

    def _tokens_joined(self, windows: list[str]) -> tuple[list[np.ndarray], np.ndarray] | None:
        """The same of several windows that spaces join, if the whole of them comes back."""
        texts = [" ".join(windows[i : i + JOINED]) for i in range(0, len(windows), JOINED)]
        spaced = [" " + t for t in texts]
        whole, last = "".join(spaced).encode(), np.cumsum([1 + len(w.encode()) for w in windows])
        found, counts = [], []
        for vocabulary, side, encoded in zip((self.a, self.b), self.sides, (self.a.encode(spaced), self.b.encode(texts)), strict=True):
            ids = list(chain.from_iterable(encoded))
            if b"".join(map(vocabulary.bytes.__getitem__, ids)) != whole:
                return None
            found.append(np.array(ids, np.int64))
            counts.append(np.diff(np.searchsorted(np.cumsum(side.lengths[found[-1]]), last, side="right"), prepend=0))
        return found, np.stack(counts)

    def _forget(self) -> None:
        """The newer half becomes the older one, but for long windows; the older one goes."""
        kept = [key for key in self.memo if len(key) <= MEMO_LETTERS]
        numbers = [self.memo[key] for key in kept]
        at = np.array(numbers, np.int64)
        self.strings = list(map(self.strings.__getitem__, numbers))
        self._hold(self.figures[:, at], self.pairs[_picked(self.begins[at], self.figures[3, at])])
        self.older = {key: number for number, key in enumerate(kept)}
        self.memo = Numbers(self.older)

    def aligned(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, str, np.ndarray, np.ndarray]]:
        """Of each text: tokens of both sides, groups, links, the groups as text, the linked pairs of ids and how
        often each is linked."""
        cut = [(windows_of(t) if self.b.apart else [t]) if t else [] for t in texts]
        found = list(map(self.memo.__getitem__, [w for windows in cut for w in windows]))
        if self.memo.new:
            self._learn(self.memo.new)
            self.memo.new = []
        numbers, first = np.array(found, np.int64), np.append(0, np.cumsum([len(windows) for windows in cut]))
        # A text has tokens if all its windows have some.
        without = np.append(0, np.cumsum(self.figures[0, numbers] == 0))[first]
        whole = (np.diff(without) == 0) & (np.diff(first) > 0)
        numbers = numbers[np.repeat(whole, np.diff(first))]
        strings = list(map(self.strings.__getitem__, numbers.tolist()))
        first = np.append(0, np.cumsum(np.diff(first) * whole))
        figures = self.figures[:, numbers]
        pairs = self.pairs[_picked(self.begins[numbers], figures[3])]
        if len(self.memo) > MEMO_WINDOWS // 2 or len(self.pairs) > MEMO_WINDOWS * MEMO_PAIRS:
            self._forget()
        figures = np.diff(np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(figures, axis=1)], axis=1)[:, first], axis=1)
        # Linked pairs of all texts, each with the number of its text.
        number = np.repeat(np.arange(len(texts)), figures[3])
        found, times = np.unique(number * SIDE * SIDE + pairs, return_counts=True)
        cuts = np.searchsorted(found, np.arange(len(texts) + 1) * SIDE * SIDE).tolist()
        found %= SIDE * SIDE
        first = first.tolist()
        for at, (n_a, n_b, groups, links) in enumerate(figures.T.tolist()):
            held = slice(cuts[at], cuts[at + 1])
            yield n_a, n_b, groups, links, ";".join(strings[first[at] : first[at + 1]]), found[held], times[held]


@lru_cache(maxsize=1)
def _vocabularies(byte_level: str, pieces: str) -> tuple[ByteLevel, Pieces]:
    """Both vocabularies, read once by a Python process whatever tasks it runs."""
    return ByteLevel(byte_level), Pieces(pieces)


def _steps(texts: list[str]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for at, text in enumerate(texts):
        if at > first and size + len(text) > STEP_BYTES:
            yield first, at
            first, size = at, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def token_links(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    byte_level: str = BYTE_LEVEL,
    pieces: str = PIECES,
    groups: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document, in blocks: block, id, n_a, n_b, n_groups, n_links, groups_sha256, and arrays of
    the distinct linked pairs (id of A times ``SIDE`` plus id of B) and how often each is linked; with ``groups`` the groups
    themselves."""
    docs = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    docs = docs.withColumn("task", F.monotonically_increasing_id())
    kind = docs.schema["id"].dataType.simpleString()
    more = ", groups string" if groups else ""

    def rows(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ids and windows are many small objects without cycles, which the collector would walk in vain.
        collecting = gc.isenabled()
        gc.disable()
        try:
            yield from found(table)
        finally:
            if collecting:
                gc.enable()

    def found(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block, size = None, None, 0
        for batch in batches(table):
            aligner = aligner or Aligner(*_vocabularies(byte_level, pieces))
            texts, numbers = batch.column("text").to_pylist(), batch.column("task").to_pylist()
            for lo, hi in _steps(texts):
                blocks, aligned_ = [], list(aligner.aligned(texts[lo:hi]))
                for number, text in zip(numbers[lo:hi], texts[lo:hi], strict=True):
                    # A block is named after its first row.
                    if block is None or size + len(text) > block_bytes:
                        block, size = number, 0
                    size += len(text)
                    blocks.append(block)
                n_a, n_b, n_groups, n_links, strings, pairs, times = zip(*aligned_, strict=True)
                digests = [hashlib.sha256(s.encode()).hexdigest() if n else "" for s, n in zip(strings, n_a, strict=True)]
                cuts = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in pairs])]), pa.int32())
                columns = [pa.array(blocks, pa.int64()), batch.column("id").slice(lo, hi - lo)]
                columns += [pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups, n_links)] + [pa.array(digests)]
                columns += [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(c))) for c in (pairs, times)]
                names = ["block", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
                if groups:
                    columns, names = [*columns, pa.array(strings)], [*names, "groups"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(
        rows,
        f"block bigint, id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        f"pairs array<bigint>, times array<bigint>{more}",
    )


def pair_counts(links: DataFrame) -> DataFrame:
    """Of every linked pair of ids: in how many documents it is linked, and whether that is the most of its A id."""
    counts = materialise(links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    a = F.shiftright("pair", SIDE.bit_length() - 1)
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return counts.withColumn("a", a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _summed(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's documents with the sums over their links, from the block's distinct pairs."""
    docs, found = left.combine_chunks(), right.combine_chunks()
    keys = np.asarray(found.column("pair"))
    order = np.argsort(keys)
    n, best = np.asarray(found.column("n"))[order], np.asarray(found.column("best").cast(pa.int64()))[order]
    lists = docs.column("pairs").combine_chunks() if docs.num_rows else None
    sums = [np.zeros(docs.num_rows, np.int64), np.zeros(docs.num_rows, np.int64)]
    if docs.num_rows and len(keys):
        lengths = np.asarray(lists.value_lengths()).astype(np.int64)
        at = np.searchsorted(keys[order], np.asarray(lists.flatten()))
        times = np.asarray(docs.column("times").combine_chunks().flatten())
        ends = np.cumsum(lengths)
        for out, value in zip(sums, (best, n), strict=True):
            total = np.concatenate([[0], np.cumsum(value[at] * times)])
            out[:] = total[ends] - total[ends - lengths]
    kept = [c for c in docs.column_names if c not in ("block", "pairs", "times")]
    return docs.select(kept).append_column("n_best", pa.array(sums[0])).append_column("count_sum", pa.array(sums[1]))


def aligned(docs: DataFrame, id_column: str = "doc_id", **options: object) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, groups_sha256, n_best and count_sum; the
    options are those of ``token_links``."""
    links = materialise(token_links(docs, id_column, **options), "token-links")
    wanted = links.select(F.col("block").alias("place"), F.explode("pairs").alias("pair")).distinct()
    found = wanted.join(pair_counts(links), "pair")
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in links.schema if f.name not in ("block", "pairs", "times"))
    summed: Callable[[pa.Table, pa.Table], pa.Table] = _summed
    out = links.groupBy("block").cogroup(found.groupBy("place")).applyInArrow(summed, f"{kept}, n_best bigint, count_sum bigint")
    return out.withColumnRenamed("id", id_column)
