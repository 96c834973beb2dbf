import hashlib
import re
import textwrap

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from firnspark.llm.licenses import TEMPLATES, scan
from firnspark.llm.merkle import edited_fingerprints, fingerprints
from tests.compare import compare, connect
from tests.llm.cases import SF, awkward, awkward_rows, no_rows

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


@pytest.mark.parametrize("name", ["op2_license_scan", "op4_document_fingerprints", "op7_url_filter", "op9_warc"])
def test_against_sql(spark, name):
    assert compare(spark, connect(SF), name, contract.queries()[name], contract.oracle_sql()[name], SF) == ""


def found(text):
    """Labels and best containment by comparing every window with every template."""
    labels, best, blocks = set(), 0.0, 0
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    for label, template in TEMPLATES:
        n, own = len(template.split()), set(template.split())
        for start in range(0, len(words), n):
            share = len(own & set(words[start : start + 2 * n])) / len(own)
            if share >= 0.9:
                labels.add(label)
                best, blocks = max(best, share), blocks + 1
    return labels, best, blocks


def wrapped(text, width=60, before="# "):
    return "\n".join(before + line for line in textwrap.wrap(text, width))


def scattered(words, gap):
    return " ".join(w + " x" * gap for w in words)


def test_blocks_against_all_templates(spark):
    long = TEMPLATES[1][1].split()
    texts = [
        "Released under the MIT License.", "licensed under CC BY-SA 4.0!", "Licensed under CC BY 4.0", "MIT\nLicense",
        " ".join(long), " ".join(long[1:]), " ".join(long[3:]), " ".join(reversed(long)) + " and more",
        "the terms of the GNU Lesser General\nPublic License", "under the terms of the gnu lesser general public license v3",
        "x " * 5000 + "released under the mit license", "MIT license, Apache License; mit   LICENSE", None, "", "license",
    ]
    texts += ["word " * (7 * i) + wrapped(template, 20 + 5 * i) + " more words" * i for i, (_, template) in enumerate(TEMPLATES)]
    texts += [scattered(template.split(), 300) for _, template in TEMPLATES]
    rows = scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        labels, best, blocks = found(texts[r.doc_id])
        base = {x for x in r.base_labels.split(",") if x}
        assert {x for x in r.labels.split(",") if x} == base | labels
        assert (r.score, r.n_blocks) == (1.0 if r.n_base else best, blocks)
    by = {r.doc_id: r for r in rows}
    assert (by[11].n_base, by[11].first_word, by[11].last_word, by[11].base_labels) == (3, 0, 4, "apache,mit")
    assert (by[3].n_base, by[3].n_blocks, by[12].n_words, by[12].first_word, by[12].labels) == (1, 0, 0, None, "")
    for i, (label, _) in enumerate(TEMPLATES):
        assert label in by[15 + i].labels.split(",")
        assert label not in by[15 + len(TEMPLATES) + i].labels.split(",")


def test_usual_headers(spark):
    texts = [
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated",
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that",
        " * Licensed under the Apache License, Version 2.0 (the \"License\");\n * you may not use this file except in compliance",
        "modify it under the terms of the GNU Lesser\n# General Public License as published",
    ]
    rows = scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.labels for r in rows] == ["mit", "bsd", "apache", "gpl,lgpl"]


def test_scan_takes_awkward_rows(spark):
    assert scan(awkward(spark)).count() == len(awkward_rows())
    assert scan(no_rows(spark)).collect() == []


def test_fingerprints(spark):
    texts = ["a\n\nb", "a\nb", "a\n\n\nb", "ab", "", None, "a\n\nb", "\n", "\n\n", "a\n\nb "]
    rows = fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    by = {r.doc_id: r.fingerprint for r in rows}
    plain = [t or "" for t in texts]
    for i in by:
        for j in by:
            assert (by[i] == by[j]) == (plain[i] == plain[j])
    assert [len(s.paragraphs) for s in rows[0].sections] == [1, 1]


def test_edits_are_located(spark):
    first = "One. Two.\nThree.\n\nFour.\nFive six seven eight nine ten eleven twelve."
    rows = [(2, first), (1, "zzz"), (0, "Other text. " * 30)]
    got = {r.doc_id: r for r in edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    n = len(first)
    edited = first[: n - n // 3] + "zzz"
    assert got[2].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert (got[2].edit_section, got[2].edit_paragraph) == (1, 1)
    assert 0 < got[2].near_edited < 1 and got[2].near_next == 0
    assert got[0].edited_sha256 == hashlib.sha256((rows[2][1][:240] + first[:120]).encode()).hexdigest()


def test_fingerprints_take_awkward_rows(spark):
    rows = edited_fingerprints(awkward(spark)).collect()
    assert len(rows) == len(awkward_rows())
    assert sum(r.doc_id is None for r in rows) == 2
    same = [r for r in rows if r.doc_id == 13]
    assert same[0] == same[1] and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    ids = [r[0] for r in awkward_rows() if r[0] in (5, 6, 7)]
    text = {r[0]: r[1] for r in awkward_rows()}
    by = {r.doc_id: r for r in rows}
    for i in ids[1:]:
        m = len(text[i]) // 3
        assert by[i].edited_sha256 == hashlib.sha256((text[i][: len(text[i]) - m] + text[i - 1][:m]).encode()).hexdigest()
    assert edited_fingerprints(no_rows(spark)).collect() == []
    one = edited_fingerprints(no_rows(spark).union(spark.range(1).select(F.lit(1), F.lit("abc"), F.lit(""), F.lit(""), F.lit(3)))).first()
    assert (one.n_chars, one.near_next) == (3, 1.0)
