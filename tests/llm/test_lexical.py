import math
import re
from collections import Counter

from firnspark.llm.lexical import length_norms, ranked
from tests.llm.cases import SF, awkward, awkward_rows, documents, no_rows

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall((text or "").encode().lower())


def plain(docs, items, top=10):
    """Every document scored for every item."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    documents, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for doc, c in counted:
            m = 25 + 75 * c.total() * documents // total
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text)
                if c[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        for rank, (score, unnamed, doc) in enumerate(sorted(scores)[:top], 1):
            out.append((item, rank, None if unnamed else doc, -score))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_whole_table_against_all_documents(spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = documents(spark)
    wanted = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows_of(ranked(docs, items)) == wanted
    # Many blocks of items give the same ranking.
    assert rows_of(ranked(docs, items, block_bytes=2500)) == wanted


def test_awkward_rows(spark):
    rows = [
        (1, "one two two"), (2, None), (3, ""), (4, "... !!"), (5, "SAME Id"), (5, "SAME Id"), (5, "no id here"),
        (None, "same id no id here one"), (6, awkward_rows()[4][1]), (7, "É é"), (8, "nowhere"),
    ]
    got = rows_of(ranked(awkward(spark), spark.createDataFrame(rows, ITEMS)))
    assert got == plain([(r[0], r[1]) for r in awkward_rows()], rows)
    assert {r[0] for r in got} == {1, 5, None, 6}


def test_ties_and_repeated_documents(spark):
    docs = [(i % 7 if i % 5 else None, "alpha beta") for i in range(60)] + [(100, "gamma"), (101, "gamma gamma")]
    items = [(1, "alpha"), (2, "gamma alpha alpha")]
    got = rows_of(ranked(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame(items, ITEMS)))
    assert got == plain(docs, items)


def test_no_rows(spark):
    none = spark.createDataFrame([], ITEMS)
    assert ranked(awkward(spark), none).collect() == []
    assert ranked(no_rows(spark), spark.createDataFrame([(1, "one")], ITEMS)).collect() == []


def test_lengths_past_64_bits():
    import numpy as np

    assert length_norms(np.array([10**9, 5]), 10**11, 10**13).tolist() == [25 + 75 * 10**7, 28]
