import random

import pytest

from firnspark.llm import decontaminate
from firnspark.llm.decontaminate import Matcher, best_end, budget, char_masks, contaminated, pieces, plain
from tests.llm.cases import awkward, no_rows, words

ITEMS = "item_id long, text string"


def distance(item, text):
    """Smallest edit distance of the item to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != x)))
        row = new
    return min(row)


def test_bit_vectors_against_the_table():
    draw = random.Random(3)
    for _ in range(400):
        item = "".join(draw.choice("ab") for _ in range(draw.randint(1, 9)))
        text = "".join(draw.choice("abc") for _ in range(draw.randint(0, 20)))
        assert best_end(char_masks(item), len(item), text)[0] == distance(item, text)


def test_pieces_cover_the_item():
    for n in (1, 5, 17, 100):
        item = words(n, 40)[:n]
        assert "".join(p for _, p in pieces(item, budget(item))) == item


def edited(text, edits, draw):
    out = list(text)
    for _ in range(edits):
        at = draw.randrange(len(out))
        out[at : at + 1] = draw.choice([[], ["q"], [out[at], "q"]])
    return "".join(out)


@pytest.mark.parametrize("block", [100, 16 << 20])
def test_planted_items(spark, monkeypatch, block):
    """Every item within its budget is found, and nothing beyond it; also in several blocks."""
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
    draw = random.Random(8)
    items = [(i, words(100 + i, draw.randint(8, 40))) for i in range(12)]
    rows = []
    for i in range(60):
        item = items[i % 12][1]
        hit = edited(item.upper() if i % 3 else item, draw.randint(0, 2 * budget(item)), draw)
        rows.append((i, words(500 + i, 30) + "\n " + hit.replace(" ", "  ", 1) + " " + words(900 + i, 30)))
    rows.append((60, words(77, 200)))
    found = contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)).collect()
    got = {(r.doc_id, r.item_id): r.distance for r in found}
    want = {}
    for key, text in rows:
        for number, item in items:
            d = distance(plain(item), plain(text))
            if d <= budget(plain(item)):
                want[key, number] = d
    assert got == want
    texts = dict(rows)
    for r in found:
        item = plain(items[r.item_id][1])
        assert distance(plain(texts[r.doc_id][r.start : r.stop]), item) <= 2 * r.distance + 2


def test_short_items_need_word_borders():
    matcher = Matcher([(1, "cat"), (2, "  "), (3, None), (4, "?!"), (5, "")])
    assert [h[0] for h in matcher.matches("a cat sat")] == [1]
    assert matcher.matches("concatenate ?!") == []


def test_awkward_rows(spark):
    items = spark.createDataFrame([(1, "No  ID here"), (2, None), (3, words(5, 20)), (3, words(5, 20))], ITEMS)
    got = contaminated(awkward(spark), items).collect()
    assert sorted((r.doc_id or -1, r.item_id) for r in got) == [(-1, 1), (12, 3), (12, 3)]
    assert contaminated(no_rows(spark), items).collect() == []
    assert contaminated(awkward(spark), spark.createDataFrame([], ITEMS)).collect() == []
