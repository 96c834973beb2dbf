import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from firnspark.llm import common, near_dup
from firnspark.llm.near_dup import near_duplicates
from firnspark.session import FEWEST_TASKS, materialise
from tests.llm.cases import awkward, awkward_rows, documents, no_rows

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text):
    words = [w for w in re.split("[ \t-\r]+", (text or "").translate(LOWER)) if w]
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """Component by id, from all pairs that share a shingle."""
    sets, parent, held = {}, {}, defaultdict(set)
    for key, text in rows:
        sets[key] = shingles(text)
        parent[key] = key
        for s in sets[key]:
            held[s].add(key)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for key, own in sets.items():
        for other, n in Counter(o for s in own for o in held[s] if o > key).items():
            if 100 * n >= 75 * (len(own) + len(sets[other]) - n):
                a, b = sorted((find(key), find(other)))
                parent[b] = a
    return {k: (len(sets[k]), find(k)) for k in sets}


def test_against_all_pairs(spark):
    docs = documents(spark)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_chains_and_edits(spark):
    draw, rows = random.Random(5), []
    for group in range(6):
        base = [f"w{group}x{i}" for i in range(draw.randint(5, 160))]
        for _ in range(12):
            if draw.random() < 0.7:
                base = list(base)
                base[draw.randrange(len(base))] = f"e{draw.random()}"
            rows.append((len(rows), " ".join(base).upper()))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


@pytest.mark.parametrize("large", [2, 8192])
def test_large_keys_lose_nothing(spark, monkeypatch, large):
    monkeypatch.setattr(near_dup, "LARGE_KEY", large)
    rows = [(i, " ".join([f"c{j}" for j in range(40)] + [f"o{i}x{j}" for j in range(6 + i % 5)])) for i in range(60)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_awkward_rows(spark):
    got = near_duplicates(awkward(spark)).collect()
    assert len(got) == len(awkward_rows())
    by_id = {r.doc_id: r for r in got}
    assert (by_id[1].n_shingles, by_id[1].component_id, by_id[1].kept) == (0, 1, True)
    assert by_id[2].component_id == 2 and by_id[11].n_shingles == 0
    assert (by_id[4].component_id, by_id[4].kept) == (3, False)
    assert (by_id[6].component_id, by_id[6].kept) == (5, False)
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert [r.component_id for r in got if r.doc_id == 13] == [13, 13]


def test_no_rows(spark):
    assert near_duplicates(no_rows(spark)).collect() == []


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (20, 20), (5, 1), (1, 2)]
    got = common.components(spark.createDataFrame(edges, "a long, b long"))
    want = {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 7, 8: 7, 9: 7}
    assert {r.id: r.component for r in got.collect()} == want
    path = [(i, i + 1) for i in range(200)]
    got = common.components(spark.createDataFrame(path, "a long, b long")).collect()
    assert len(got) == 201 and {r.component for r in got} == {0}


def test_components_write_little(spark, monkeypatch):
    """Pairs and a chain end after one round, and no step has a file for every shuffle partition."""
    files = []

    def counted(df, *args, **more):
        copy = materialise(df, *args, **more)
        files.append(len(copy.inputFiles()))
        return copy

    monkeypatch.setattr(common, "materialise", counted)
    edges = [(2 * i, 2 * i + 1) for i in range(100, 400)] + [(1, 2), (2, 3), (1, 3)]
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        got = common.components(spark.createDataFrame(edges, "a long, b long"))
        assert {(r.id, r.component) for r in got.collect()} == {(b, a) for a, b in edges[:300]} | {(a, a) for a, _ in edges[:300]} | {(1, 1), (2, 1), (3, 1)}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(files) <= 4 and max(files[1:]) <= FEWEST_TASKS


def test_pigeonhole_guarantee():
    """Any two signatures within the distance share an index key."""
    draw = np.random.default_rng(1)
    most = near_dup.CHUNKS * (near_dup.ERRORS + 1) - 1
    import pyarrow as pa

    a = draw.integers(0, 2**32, (200, near_dup.SYMBOLS), dtype=np.uint32)
    b = a.copy()
    for row in b:
        row[draw.choice(near_dup.SYMBOLS, most, replace=False)] ^= np.uint32(1)
    both = pa.RecordBatch.from_pydict({"id": list(range(400)), "symbols": [r.tobytes() for r in np.concatenate([a, b])]})
    keys = defaultdict(set)
    for out in near_dup._key_rows([both]):
        for key, i in zip(out["key"].to_pylist(), out["id"].to_pylist(), strict=True):
            keys[i].add(key)
    assert all(keys[i] & keys[i + 200] for i in range(200))


def test_parity_sketch_is_a_lower_bound():
    draw = np.random.default_rng(2)
    for _ in range(50):
        values = draw.integers(0, 2**63, 300, dtype=np.uint64)
        x, y = np.sort(values[: draw.integers(1, 300)]), np.sort(values[draw.integers(0, 299) :])
        odd = near_dup.parity_sketches(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
        assert np.bitwise_count(odd[0] ^ odd[1]).sum() <= len(set(x) ^ set(y))


def test_blocks_of_a_large_key_hold_every_pair(spark, monkeypatch):
    """Two members of different components meet in exactly one block; the main component meets only the rest."""
    monkeypatch.setattr(near_dup, "LARGE_KEY", 4)
    rows = [(1, i, 100 if i < 30 else 200 + i // 3) for i in range(50)] + [(2, i, i) for i in range(11)] + [(3, 1, 5), (3, 2, 6)]
    blocks = defaultdict(list)
    for r in near_dup._in_blocks(spark.createDataFrame(rows, "key long, id long, component long")).collect():
        blocks[r.key].append(r)
    met = defaultdict(int)
    for held in blocks.values():
        assert max(Counter(r.side for r in held).values()) < 25
        for i, x in enumerate(held):
            for y in held[i + 1 :]:
                if x.component != y.component and (x.side < 0 or x.side != y.side):
                    met[min(x.id, y.id), max(x.id, y.id), min(x.component, y.component), max(x.component, y.component)] += 1
    want = set()
    for key in (1, 2, 3):
        own = [(i, c) for k, i, c in rows if k == key]
        want |= {(min(i, j), max(i, j), min(c, d), max(c, d)) for i, c in own for j, d in own if i < j and c != d}
    assert set(met) == want and set(met.values()) == {1}
