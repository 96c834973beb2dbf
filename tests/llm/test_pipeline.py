import corpus_pipeline
from firnspark.llm import toxicity
from firnspark.session import materialise
from tests.llm.cases import SCHEMA, SF, awkward, no_rows, words
from tests.llm.test_decontaminate import distance
from tests.llm.test_near_dup import brute as near_groups
from tests.llm.test_suffix_dedup import LENGTH


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialise(stage(spark, docs, SF), name)
        kept[name] = (before, docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS and dict(docs.dtypes) == dict(before.dtypes)

    before, after = kept["toxicity"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    gone = {r.doc_id for r in toxicity.toxicity(before, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - gone

    before, after = kept["minhash_near_dedup"]
    groups = near_groups([(r.doc_id, r.text) for r in before.collect()])
    assert {r.doc_id for r in after.collect()} == {i for i, (_, top) in groups.items() if i == top}

    before, after = kept["suffix_array_dedup"]
    texts = {r.doc_id: r.text for r in after.collect()}
    assert set(texts) == {r.doc_id for r in before.collect()}
    raw = {r.doc_id: r.text.encode() for r in before.collect()}
    seen = {}
    for b in raw.values():
        for i in range(len(b) - LENGTH + 1):
            seen[b[i : i + LENGTH]] = seen.get(b[i : i + LENGTH], 0) + 1
    for key, b in raw.items():
        gone = {p for i in range(len(b) - LENGTH + 1) if seen[b[i : i + LENGTH]] > 1 for p in range(i, i + LENGTH)}
        assert texts[key] == bytes(c for p, c in enumerate(b) if p not in gone).decode("utf-8", "ignore")

    before, after = kept["benchmark_decontamination"]
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id for r in after.collect()}
    for r in before.collect():
        text = " ".join(r.text.lower().split())
        held = any(i in text for i in items)
        assert not (held and r.doc_id in left)
        if r.doc_id not in left and not held:
            assert any(distance(i, text) <= 0.08 * len(i) for i in items)

    before, after = kept["best_fit_packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}


def test_stages_take_awkward_rows(spark):
    for docs in (awkward(spark), no_rows(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, SF), name)
        assert docs.columns[0] == "doc_id"


def test_registered():
    import __spark_entry__ as contract

    names = {n.split("_")[0] for n in contract.queries() if n.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)} and contract.queries()["pipeline"] is corpus_pipeline.run


def test_rows_are_judged_on_their_own(spark):
    """Repeated rows and null ids: of each text one row stays whole; bad texts go without others of their id."""
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").limit(2).collect()]
    texts = [words(100 + i, 60) for i in range(4)]
    assert min(map(len, texts)) > 200
    rows = [(1, texts[0]), (1, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]), (7, texts[2])]
    rows += [(8, texts[3]), (8, words(9, 30) + " " + items[0] + " " + words(10, 30)), (None, words(11, 30) + " " + items[1])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    for stage in (corpus_pipeline.near_dedup, corpus_pipeline.remove_repeats, corpus_pipeline.decontaminate):
        docs = materialise(stage(spark, docs, SF))
    left = sorted(((r.doc_id or 0, r.text) for r in docs.collect()))
    assert left == sorted([(1, texts[0]), (0, texts[1]), (7, texts[2]), (8, texts[3])])


def test_toxic_rows_without_an_id_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.toxicity(docs, labels).where("predicted = 1").select("doc_id").collect()
    bad = docs.where(docs.doc_id == scored[0].doc_id)
    both = docs.unionByName(bad.selectExpr("cast(null as bigint) as doc_id", "text", "lang", "source", "n_chars"))
    assert corpus_pipeline.drop_toxic(spark, both, SF).where("doc_id is null").count() == 0
