import hashlib
import random
from collections import Counter, defaultdict

import pytest

from firnspark.llm import alignment as module
from firnspark.llm.alignment import Aligner, ByteLevel, Pieces, aligned, token_links
from tests.llm.cases import awkward, awkward_rows, documents, no_rows


@pytest.fixture(scope="module")
def sides():
    return ByteLevel(module.BYTE_LEVEL), Pieces(module.PIECES)


def spans(ids, of):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(of[i]), i))
        at += len(of[i])
    return out


def plain(rows, sides):
    """Every figure by comparing all tokens of a text with all others."""
    a, b = sides
    found, holding = [], Counter()
    for doc, text in rows:
        whole = " " + (text or "")
        ids_a, ids_b = a.encode([whole])[0], b.encode([text or ""])[0]
        joined = [b"".join(side.bytes[i] for i in ids) for side, ids in ((a, ids_a), (b, ids_b))]
        if not text or joined != [whole.encode()] * 2:
            found.append((doc, 0, 0, 0, "", Counter()))
            continue
        left, right = spans(ids_a, a.bytes), spans(ids_b, b.bytes)
        links, j = Counter(), 0
        for s, e, i in left:
            while right[j][1] <= s:
                j += 1
            k = j
            while k < len(right) and right[k][0] < e:
                links[i, right[k][2]] += 1
                k += 1
        shared = sorted({e for _, e, _ in left} & {e for _, e, _ in right})
        groups, last = [], 0
        held = [defaultdict(list), defaultdict(list)]
        place = {e: n for n, e in enumerate(shared)}
        for out, side in zip(held, (left, right), strict=True):
            n = 0
            for _, e, i in side:
                out[n].append(i)
                n += e in place
        groups = ";".join(",".join(map(str, held[0][n])) + "|" + ",".join(map(str, held[1][n])) for n in range(len(shared)))
        holding.update(links.keys())
        found.append((doc, len(left), len(right), len(shared), hashlib.sha256(groups.encode()).hexdigest(), links))
    most = defaultdict(int)
    for (i, _), n in holding.items():
        most[i] = max(most[i], n)
    return sorted(
        (str(doc), n_a, n_b, n_groups, digest, links.total(), sum(t for p, t in links.items() if holding[p] == most[p[0]]),
         sum(t * holding[p] for p, t in links.items()))
        for doc, n_a, n_b, n_groups, digest, links in found
    )


def rows_of(df):
    return sorted(
        (str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.groups_sha256, r.n_links, r.n_best, r.count_sum) for r in df.collect()
    )


def test_whole_table_against_all_tokens(spark, sides):
    df = documents(spark)
    assert rows_of(aligned(df)) == plain([(r.doc_id, r.text) for r in df.collect()], sides)


def test_awkward_rows(spark, sides):
    odd = ["<|endoftext|> and <s> x", "a▁b", "two  spaces\t\n tab", "日本語 text 🙂🙂", "\x00nul", " leading", "trailing ", "ﬁ ligature", "é"]
    rows = [(r[0], r[1]) for r in awkward_rows()] + [(100 + i, t) for i, t in enumerate(odd)]
    more = awkward(spark).unionByName(
        spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"), allowMissingColumns=True
    )
    got = rows_of(aligned(more, block_bytes=300))
    assert got == plain(rows, sides)
    zero = [r for r in got if r[0] in ("1", "2")]
    assert [r[1:] for r in zero] == [(0, 0, 0, "", 0, 0, 0)] * 2
    # A text that holds the piece model's own mark for a space does not come back as it was.
    assert [r[1] for r in got if r[0] == "101"] == [0]
    assert any(r[1] for r in got if r[0] == "100")


def test_no_rows(spark):
    assert aligned(no_rows(spark)).collect() == []


def test_groups_are_kept_on_request(spark):
    for r in token_links(documents(spark).limit(5), groups=True).collect():
        assert hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256
        assert sum(len(g.split("|")[0].split(",")) for g in r.groups.split(";")) == r.n_a


def test_windows_are_looked_up_and_the_memory_is_bounded(sides, monkeypatch):
    aligner = Aligner(*sides)
    text = "the quick brown fox " * 50
    first = list(aligner.aligned([text]))
    assert 0 < len(aligner.memo) < 12 and not aligner.older
    again = list(aligner.aligned([text]))
    assert [x[:5] for x in first] == [x[:5] for x in again]
    monkeypatch.setattr(module, "MEMO_WINDOWS", 3)
    list(aligner.aligned(["seven other words to be kept " * 3]))
    assert not aligner.memo and aligner.older
    assert [x[:5] for x in aligner.aligned([text])] == [x[:5] for x in first]


def test_older_windows_keep_their_alignments(sides, monkeypatch):
    """Whatever is forgotten meanwhile, texts are aligned as by an aligner that has met nothing."""
    monkeypatch.setattr(module, "MEMO_WINDOWS", 8)
    aligner, words = Aligner(*sides), "one 2two three-four fünf sechs's 日本語 seven88 x".split()
    texts = [" ".join(words[i % 8 :] + words[: i % 5] + [f"w{i}" * (1 + i % 40)]) for i in range(60)]
    for i in range(0, 60, 3):
        for got, text in zip(aligner.aligned(texts[i : i + 3]), texts[i : i + 3], strict=True):
            (want,) = Aligner(*sides).aligned([text])
            assert got[:5] == want[:5]
            assert got[5].tolist() == want[5].tolist() and got[6].tolist() == want[6].tolist()
        assert len(aligner.strings) == aligner.figures.shape[1] <= 40


def test_windows_have_the_tokens_of_the_whole_text(sides, monkeypatch):
    """Blanks of all kinds, marks and runs of spaces at every place; each distinct window is tokenised once."""
    monkeypatch.setattr(module, "JOINED", 3)
    draw = random.Random(3)
    parts = [" ", "  ", "    ", "\n", " \n", "\t ", "\u00a0", "\u2003", "\x85", "\x1c", "\u200b", "\u0308", "'s", "a", "Word", "12", "!?", "日本", "🙂", "▁", "é"]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 12))) for _ in range(1500)]
    rows = list(enumerate(texts))
    got, holding = list(Aligner(*sides).aligned(texts)), plain(rows, sides)
    figures = {str(i): (r[0], r[1], r[2], hashlib.sha256(r[4].encode()).hexdigest() if r[0] else "", r[3]) for i, r in enumerate(got)}
    assert figures == {r[0]: r[1:6] for r in holding}
    assert 0 < sum(not r[0] for r in got) < len(got)
    counted, encode = [], sides[1].encode
    monkeypatch.setattr(sides[1], "encode", lambda texts: counted.extend(" ".join(texts).split()) or encode(texts))
    list(Aligner(*sides).aligned(["some words and some other words"] * 50))
    assert sorted(counted) == ["and", "other", "some", "words"]


def test_vocabularies_are_read_once_by_a_process():
    a, b = module._vocabularies(module.BYTE_LEVEL, module.PIECES)
    assert module._vocabularies(module.BYTE_LEVEL, module.PIECES) == (a, b)
    # What only very long runs of blanks need is not read for others.
    assert a.encode([" some words"]) and a.tokenizer is None


def test_ids_are_those_of_the_vocabulary_file(spark, sides):
    """The ranks give the same ids as the library that the vocabulary file was written for."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(module.BYTE_LEVEL)
    whole.encode_special_tokens = True
    texts = [" " + (r.text or "") for r in documents(spark).collect()] + ["\u2003\x85\xa0 a's  \n\n x<|endoftext|>", "٣1²", "\u200b\ufeff a"]
    assert sides[0].encode(texts) == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_very_long_runs(sides):
    """Runs of blanks and of letters as long as a text; the alignment covers every byte."""
    for text in (" " * 1_500_000 + "a b", "a" * 1_000_000, "\n" * 60_000 + "x", "日本" * 100_000):
        (n_a, n_b, n_groups, n_links, groups, _, times), = Aligner(*sides).aligned([text])
        assert n_a and n_b and n_links == times.sum() >= max(n_a, n_b) >= n_groups == groups.count("|")
