import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path
from urllib.parse import urlparse

import numpy as np

from firnspark.llm import toxicity as module
from firnspark.llm.common import word_hashes
from firnspark.llm.toxicity import toxicity
from firnspark.session import discard, gathered, materialise, shared_root
from tests.llm.cases import SF, awkward, awkward_rows, no_rows, words

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=1500, seed=4):
    draw = random.Random(seed)
    vocabulary = [f"{draw.choice('bcdfg')}{draw.randint(0, 9999)}" for _ in range(800)]
    rows, labels = [], []
    for i in range(n):
        bad = draw.random() < 0.15
        text = [draw.choice(vocabulary) for _ in range(draw.randint(10, 150))]
        for _ in range(draw.randint(2, 6) if bad else 0):
            text.insert(draw.randrange(len(text)), draw.choice(["Grublin,", "snarfo", "vexwort!"]))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    got = toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)).collect()
    truth = {i: t for i, _, t in labels}
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    hits = [r.predicted for r in held if truth[r.doc_id]]
    assert np.mean(hits) > 0.8


def test_held_out_labels_are_not_used(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = (
        {r.doc_id: r.score for r in toxicity(docs, spark.createDataFrame(x, LABELS)).collect()} for x in (labels, turned)
    )
    assert a == b


def test_awkward_rows_and_labels(spark):
    labels = [(5, 1, 1), (7, 1, 0), (7, 1, 1), (8, 0, None), (None, 1, 1), (13, 1, 0), (99, 1, 1)]
    got = toxicity(awkward(spark), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(awkward_rows())
    assert all(0 <= r.score <= 1 for r in got) and not any(r.held_out for r in got if r.doc_id is None)
    same = [r.score for r in got if r.doc_id in (1, 2, 11)]
    assert len(set(same)) == 1


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], LABELS)
    assert {r.predicted for r in toxicity(awkward(spark), none).collect()} == {0}
    assert toxicity(no_rows(spark), none).collect() == []


def plain_models(rows):
    """Both models by counting in Python: probabilities of a word after another and alone, by class."""
    n, k = [Counter(), Counter(), Counter()], [Counter(), Counter(), Counter()]
    for text, toxic in rows:
        words = re.findall(r"[a-z0-9]+", text.lower())
        for pair in set(zip(["", *words], words, strict=False)):
            n[toxic][pair] += 1
            n[2][pair] += 1
    for counts, alone in zip(n, k, strict=True):
        alone.update(w for _, w in counts)
    cuts, word_cuts = ([(0.0, *module.discounts_of([sum(x == i for x in c.values()) for i in (1, 2, 3, 4)])) for c in of] for of in (n, k))
    known, toxic_words = set(n[1]), set(k[1])

    def kept(count, cut):
        return count - cut[min(count, 3)]

    totals = [Counter() for _ in n]
    used = [Counter() for _ in n]
    for c, counts in enumerate(n):
        for pair, count in counts.items():
            totals[c][pair[0]] += count
            used[c][pair[0]] += kept(count, cuts[c]) if pair in known else 0
    over = [1 - sum(kept(k[c][w], word_cuts[c]) for w in toxic_words) / k[c].total() for c in (0, 1)]

    def alone(c, w):
        own = kept(k[c][w], word_cuts[c]) / k[c].total() if w in toxic_words else 0
        return own + over[c] * k[2][w] / k[2].total()

    def after(c, v, w):
        left = [1 - used[i][v] / totals[i][v] if totals[i][v] else 1 for i in (c, 2)]
        own = shared = 0
        if (v, w) in known:
            own = kept(n[c][v, w], cuts[c]) / totals[c][v] if totals[c][v] else 0
            shared = kept(n[2][v, w], cuts[2]) / totals[2][v]
        return own + left[0] * (shared + left[1] * alone(c, w))

    return after, alone, sorted(k[2]), sorted({v for v, _ in n[2]})


def test_models_against_counting(spark):
    """Every probability sums to one over all words, and the table gives the log ratios of the plain models."""
    rows, labels = corpus(160, seed=8)
    truth = {i: t for i, _, t in labels}
    texts = [(t, truth[i]) for i, t in rows]
    after, alone, words, contexts = plain_models(texts)
    for c in (0, 1):
        assert np.isclose(sum(alone(c, w) for w in words), 1)
        for v in contexts[::25]:
            assert np.isclose(sum(after(c, v, w) for w in words), 1)
    model, other = module.model_table(spark.createDataFrame(texts, "text string, toxic int"))
    table = model.toArrow()
    found = module.Found(np.asarray(table.column("key")), np.asarray(table.column("ratio")), other)
    for text, _ in texts[:40]:
        data = np.frombuffer(text.encode(), np.uint8)
        pairs, single = found.log_ratios(*module.words_of(data, np.array([0, len(data)]))[:2])
        own = re.findall(r"[a-z0-9]+", text.lower())
        before = ["", *own[:-1]]
        assert np.allclose(single, [np.log(alone(1, w) / alone(0, w)) for w in own], atol=1e-5)
        assert np.allclose(pairs, [np.log(after(1, v, w) / after(0, v, w)) for v, w in zip(before, own, strict=True)], atol=1e-5)


def test_blocks_and_broadcast_agree(spark, monkeypatch):
    rows, labels = corpus(400)
    rows += [(9000, None), (9001, ""), (9002, words(3, 5000))]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)
    whole = {r.doc_id: r.score for r in toxicity(docs, marks).collect()}
    monkeypatch.setattr(module, "BLOCK_BYTES", 3000)
    assert {r.doc_id: r.score for r in toxicity(docs, marks, model_bytes=-1).collect()} == whole


def test_accuracy_on_the_given_table(spark):
    """Held-out rows: the ranking, the toxic rows found and the others left alone; likelihoods have a say."""
    folder = SF.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = toxicity(docs, labels).where("held_out").join(labels.select("doc_id", "toxic"), "doc_id").toPandas()
    rank = got["score"].rank()
    toxic = got["toxic"] == 1
    a, b = int(toxic.sum()), int((~toxic).sum())
    assert (rank[toxic].sum() - a * (a + 1) / 2) / (a * b) >= 0.95
    assert got.loc[toxic, "predicted"].mean() >= 0.8 and got.loc[~toxic, "predicted"].mean() <= 0.03


def test_bounded_fit_keeps_the_share(spark, monkeypatch):
    """Labels that no text explains: the scores' mean is the toxic share, however few rows are fitted."""
    draw = random.Random(9)
    rows, _ = corpus(1500)
    labels = [(i, 1, int(draw.random() < 0.12)) for i, _ in rows]
    fold = [t for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == module.FIT_FOLD]
    monkeypatch.setattr(module, "FIT_ROWS", sum(fold))
    assert sum(fold) < len(fold) / 4
    got = toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)).collect()
    held = [r.score for r in got if r.held_out]
    assert abs(np.mean(held) - np.mean(fold)) < 0.05


def test_word_order_is_evidence(spark):
    """Both classes use the same words; only which word follows which tells them apart, and the words
    before agree in some bits of their hashes."""
    draw = random.Random(12)
    left, right = [f"left{i}" for i in range(400)], [f"right{i}" for i in range(40)]
    data = np.frombuffer(" ".join(left).encode(), np.uint8)
    bits = word_hashes(data, np.array([0, len(data)]))[0] >> np.uint64(40)
    left = [w for w, b in zip(left, bits, strict=True) if b % 4 == 0][:40]
    rows, labels = [], []
    for i in range(1200):
        bad = i % 3 == 0
        text = []
        for _ in range(30):
            j = draw.randrange(40)
            text += [left[j], right[(j + 1) % 40 if bad else j]]
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    got = toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)).collect()
    assert np.mean([r.predicted == (r.doc_id % 3 == 0) for r in got if r.held_out]) > 0.95


def test_rare_expressions_are_evidence(spark):
    """Every telling word occurs in two or three training texts, and no two of them begin alike."""
    draw = random.Random(21)
    pools = {f: [i for i in range(6000) if zlib.crc32(str(i).encode()) % 5 == f] for f in range(5)}
    learnt = [i for f in (1, 2, 3) for i in pools[f]]
    filler = [f"f{i}" for i in range(50)]
    rows, labels = [], []
    for group in range(240):
        bad, letters, rest = group % 3 == 0, "bcdfghjklm", group
        word = "".join(letters[rest // 10**k % 10] for k in range(3)) + "xqa"
        ids = [learnt.pop() for _ in range(2 + group % 2)] + [pools[0].pop(), pools[4].pop()]
        for i in ids:
            text = [draw.choice(filler) for _ in range(12)]
            text.insert(draw.randrange(13), word)
            rows.append((i, " ".join(text)))
            labels.append((i, 1, int(bad)))
    truth = {i: t for i, _, t in labels}
    got = toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)).collect()
    assert np.mean([r.predicted == truth[r.doc_id] for r in got if r.held_out]) > 0.9


def whole_models(rows):
    """Both models by counting in Python, with every pair and word of either class: probabilities of a word after
    another and alone, by class."""
    n, k = [Counter(), Counter(), Counter()], [Counter(), Counter(), Counter()]
    for text, toxic in rows:
        own = re.findall(r"[a-z0-9]+", text.lower())
        for pair in set(zip(["", *own], own, strict=False)):
            n[toxic][pair] += 1
            n[2][pair] += 1
    for counts, alone in zip(n, k, strict=True):
        alone.update(w for _, w in counts)
    cuts, word_cuts = ([(0.0, *module.discounts_of([sum(x == i for x in c.values()) for i in (1, 2, 3, 4)])) for c in of] for of in (n, k))
    totals = [Counter() for _ in n]
    spared = [Counter() for _ in n]
    for c, counts in enumerate(n):
        for (v, _), count in counts.items():
            totals[c][v] += count
            spared[c][v] += cuts[c][min(count, 3)]
    over = [sum(word_cuts[c][min(x, 3)] for x in k[c].values()) / k[c].total() for c in (0, 1)]

    def alone(c, w):
        return (k[c][w] - word_cuts[c][min(k[c][w], 3)]) / k[c].total() + over[c] * k[2][w] / k[2].total()

    def after(c, v, w):
        found = alone(c, w)
        for i in (2, c):
            if totals[i][v]:
                count = n[i][v, w]
                found = (count - cuts[i][min(count, 3)]) / totals[i][v] + spared[i][v] / totals[i][v] * found
        return found

    return after, alone, sorted(k[2]), sorted({v for v, _ in n[2]})


def test_whole_models_against_counting(spark, monkeypatch):
    """The operator's models hold the pairs and words of ordinary texts as well as those of toxic ones."""
    rows, labels = corpus(160, seed=8)
    truth = {i: t for i, _, t in labels}
    learnt = [(t, truth[i]) for i, t in rows if zlib.crc32(str(i).encode()) % 5 not in (0, module.FIT_FOLD)]
    after, alone, words, contexts = whole_models(learnt)
    for c in (0, 1):
        assert np.isclose(sum(alone(c, w) for w in words), 1)
        for v in contexts[::25]:
            assert np.isclose(sum(after(c, v, w) for w in words), 1)
    made, make = [], module.model_table
    monkeypatch.setattr(module, "model_table", lambda *options: made.append(make(*options)) or made[0])
    toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS))
    model, other = made[0]
    table = model.toArrow()
    found = module.Found(np.asarray(table.column("key")), np.asarray(table.column("ratio")), other)
    for text, _ in learnt[:40]:
        data = np.frombuffer(text.encode(), np.uint8)
        pairs, single = found.log_ratios(*module.words_of(data, np.array([0, len(data)]))[:2])
        own = re.findall(r"[a-z0-9]+", text.lower())
        before = ["", *own[:-1]]
        assert np.allclose(single, [np.log(alone(1, w) / alone(0, w)) for w in own], atol=1e-5)
        assert np.allclose(pairs, [np.log(after(1, v, w) / after(0, v, w)) for v, w in zip(before, own, strict=True)], atol=1e-5)


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    return {p for d in env.blockManager().diskBlockManager().localDirsString() for p in Path(d).glob("*/shuffle_*")}


def test_copies_and_shuffles_go_when_they_are_read(spark, monkeypatch):
    """Of a run in blocks only the labels and the evidence stay on disk."""
    rows, labels = corpus(300)
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)
    folder = Path(urlparse(shared_root(spark)).path)
    copies = set(folder.iterdir()) if folder.exists() else set()
    monkeypatch.setattr(module, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(module, "ROUNDS", 3)
    toxicity(docs, marks, model_bytes=-1)
    left = {p.name for p in set(folder.iterdir()) - copies if not p.name.endswith(".crc")}
    assert {name for name in left if not name.startswith(("toxic-labels-", "evidence-"))} == set()


def test_dropped_shuffles_and_discarded_copies(spark):
    """The setting holds for one write only; frames that are no copies are left alone."""
    before = shuffle_files(spark)
    a, b = (materialise(spark.range(i, i + 50).repartition(7), drop_shuffles=True) for i in (0, 50))
    patience = time.time() + 20
    while shuffle_files(spark) - before and time.time() < patience:
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    both = gathered([a, b])
    assert sorted(r.id for r in both.collect()) == list(range(100))
    again = spark.read.parquet(*both.inputFiles())
    discard(again)
    assert again.count() == 100
    files = [Path(urlparse(f).path) for f in both.inputFiles()]
    discard(both, both)
    assert files and not any(f.exists() for f in files)


def test_models_in_slices(spark, monkeypatch):
    rows, labels = corpus(160, seed=8)
    truth = {i: t for i, _, t in labels}
    texts = spark.createDataFrame([(t, truth[i]) for i, t in rows], "text string, toxic int")
    found = []
    for limit in (module.MODEL_BYTES, -1):
        monkeypatch.setattr(module, "MODEL_BYTES", limit)
        model, other = module.model_table(texts, False)
        found.append((sorted(model.collect()), other))
    (whole, other), (cut, cut_other) = found
    assert [r.key for r in whole] == [r.key for r in cut] and other == cut_other
    assert np.allclose([r.ratio for r in whole], [r.ratio for r in cut], atol=1e-6)


def test_ranges_answer_what_is_asked():
    """Every distinct key of a block is asked once; a range without entries, or without a wanted key, gives nothing."""
    text = "one two two three one two"
    batch = module.pa.RecordBatch.from_pydict({"block": [5, 5, 9], "text": [text, None, "two"]})
    asked = [r for part in module._wanted_rows(iter([batch]), 7) for r in part.to_pylist()]
    assert all(set(module._ranges_of(np.frombuffer(r["keys"], np.int64), 7)) == {r["range"]} for r in asked)
    data = np.frombuffer(text.encode(), np.uint8)
    wanted = set(np.concatenate(module.keys_of(*module.words_of(data, np.array([0, len(data)]))[:2])).tolist())
    got = [k for r in asked if r["place"] == 5 for k in np.frombuffer(r["keys"], np.int64).tolist()]
    assert len(got) == len(wanted) and set(got) == wanted

    def answers(cells, entries):
        kinds = module.pa.schema([("place", "int64"), ("range", "int64"), ("keys", "binary")])
        held = module.pa.schema([("range", "int64"), ("keys", "binary"), ("ratios", "binary")])
        raw = [{"place": p, "range": 0, "keys": np.array(k, np.int64).tobytes()} for p, k in cells]
        own = [{"range": 0, "keys": np.array(list(entries), np.int64).tobytes(), "ratios": np.array(list(entries.values()), np.float32).tobytes()}]
        table = module._answers(module.pa.Table.from_pylist(raw, kinds), module.pa.Table.from_pylist(own if entries else [], held))
        return [(r["place"], dict(zip(np.frombuffer(r["keys"], np.int64).tolist(), np.frombuffer(r["ratios"], np.float32).tolist(), strict=True))) for r in table.to_pylist()]

    assert answers([(1, [2, 3, 9]), (2, [3]), (3, [4])], {3: 0.5, 7: 1.0, 9: 2.0}) == [(1, {3: 0.5, 9: 2.0}), (2, {3: 0.5}), (3, {})]
    assert answers([(1, [2])], {}) == [(1, {})]
    assert answers([], {3: 0.5}) == []
