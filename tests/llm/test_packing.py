import random
from collections import defaultdict

from pyspark.sql import functions as F

from firnspark.llm import packing
from firnspark.llm.packing import best_fit, pack
from tests.llm.cases import SF, awkward, awkward_rows, documents, no_rows, words


def plain_best_fit(items, capacity):
    """The same rule by looking at every bin: the tightest that fits and has neither source nor cluster."""
    bins = []
    chosen = []
    for size, source, cluster in items:
        fits = [
            (b["left"], i) for i, b in enumerate(bins)
            if b["left"] >= size and (source is None or source not in b["sources"]) and (cluster is None or cluster not in b["clusters"])
        ]
        if fits:
            at = min(fits)[1]
        else:
            bins.append({"left": capacity, "sources": set(), "clusters": set()})
            at = len(bins) - 1
        bins[at]["left"] -= size
        bins[at]["sources"].add(source)
        bins[at]["clusters"].add(cluster)
        chosen.append(at)
    return chosen


def test_against_a_plain_search():
    draw = random.Random(4)
    for _ in range(40):
        items = [
            (draw.randint(1, 30), draw.choice([None, *"abcd"]), draw.choice([None, *range(12)])) for _ in range(draw.randint(1, 120))
        ]
        items.sort(key=lambda x: -x[0])
        got, fill = best_fit(*map(list, zip(*items, strict=True)), 30)
        assert got == plain_best_fit(items, 30)
        assert sum(fill) == sum(i[0] for i in items) and max(fill) <= 30


def check(rows, capacity=packing.CAPACITY):
    bins = defaultdict(list)
    for r in rows:
        bins[r.shard, r.bin].append(r)
    for own in bins.values():
        assert sum(r.size for r in own) == own[0].fill <= capacity
        for name in ("source", "cluster"):
            held = [r[name] for r in own if r[name] is not None]
            assert len(held) == len(set(held))


def test_documents_are_whole(spark):
    docs = documents(spark)
    rows = pack(docs, capacity=256).collect()
    check(rows, 256)
    total = {r.doc_id: len((r.text or "").split()) + 1 for r in docs.collect()}
    got = defaultdict(int)
    for r in rows:
        assert r.first_word == 256 * r.piece
        got[r.doc_id] += r.size
    assert got == total


def test_shards_and_hot_source(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 40)
    docs = documents(spark).withColumn("source", F.lit("one"))
    rows = pack(docs).collect()
    check(rows)
    assert len({r.shard for r in rows}) > 1
    assert len({(r.shard, r.bin) for r in rows}) == len(rows)


def test_awkward_rows(spark):
    rows = pack(awkward(spark)).collect()
    check(rows)
    assert len({(r.doc_id, r.cluster, r.bin, r.shard, r.piece) for r in rows}) == len(rows)
    assert sum(r.piece == 0 for r in rows) == len(awkward_rows())
    assert {r.size for r in rows if r.doc_id in (1, 2, 11)} == {1}
    assert pack(no_rows(spark)).collect() == []


def test_clusters_are_exact_beside_nulls(spark):
    docs = documents(spark).unionByName(awkward(spark, clashing=False))
    want = {r.c for r in docs.where("text <> ''").select(F.xxhash64("text").alias("c")).collect()}
    assert {r.cluster for r in pack(docs).collect() if r.cluster is not None} == want


def test_near_copies_share_no_bin(spark):
    """In the registered query the cluster is the component of near duplicates."""
    from firnspark.llm.near_dup import near_duplicates
    from firnspark.llm.queries import op1_best_fit_packing

    groups = {r.doc_id: r.component_id for r in near_duplicates(documents(spark)).collect() if r.n_shingles}
    assert len(set(groups.values())) < len(groups)
    seen = set()
    for r in op1_best_fit_packing(spark, SF).collect():
        assert r.cluster == groups.get(r.doc_id)
        assert r.cluster is None or (r.shard, r.bin, r.cluster) not in seen
        seen.add((r.shard, r.bin, r.cluster))
