"""License scan: phrase places, and an exact set-similarity join of text blocks with license templates.

The blocks of a template of n words are windows of 2 n words of the text, one every n words, whatever
its line breaks; so n consecutive words are always whole in some block, and words far apart never
meet in one.  A template is found in a block that holds at least ``CONTAINMENT`` of its distinct
words.  The join is exact:

* prefix: words are ordered by how often they stand between blanks in all texts, rarest first; a block that misses the
  first ``size - overlap + 1`` words of a template cannot reach the overlap, so only blocks around
  one of these words are candidates, by an index from word to templates;
* position: with the prefix word at a given place in that order, at most the words from there on can
  be shared, which rules out the places behind the prefix;
* length: a block with fewer words than the overlap, at the end of a text, is out.

What is left is compared in full.  The driver sees one count per template word; nothing else is
shuffled.  Everything is DataFrame and SQL functions.

Nulls count as empty texts.  An empty text has no words, no labels and score 0.  Repeated rows
are scanned each for itself, null ids included.  A very long text, with or without line breaks, is many blocks.  Equal
frequencies are ordered by word.  Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from firnspark.llm.common import text_or_empty

# Words of a text, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Base phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Notices, headers and texts of common licenses, with their labels.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
            "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
            "notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
               "the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required "
               "by applicable law or agreed to in writing software distributed under the license is distributed on an as is "
               "basis without warranties or conditions of any kind either express or implied see the license for the "
               "specific language governing permissions and limitations under the license"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
            "license as published by the free software foundation either version 3 of the license or at your option any "
            "later version this program is distributed in the hope that it will be useful but without any warranty without "
            "even the implied warranty of merchantability or fitness for a particular purpose"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
             "general public license as published by the free software foundation"),
    ("agpl", "under the terms of the gnu affero general public license"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
            "distributed with this file you can obtain one at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met redistributions of source code must retain the above copyright notice this list of "
            "conditions and the following disclaimer redistributions in binary form must reproduce the above copyright "
            "notice this list of conditions and the following disclaimer in the documentation and or other materials "
            "provided with the distribution"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify "
                  "publish use compile sell or distribute this software either in source code form or as a compiled binary "
                  "for any purpose commercial or non commercial and by any means"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
]
CONTAINMENT = 0.9


def lowered(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def phrase_places(words: str, phrase: str) -> Column:
    """Places where the words of a phrase stand consecutively."""
    parts = phrase.split()
    here = " and ".join(f"get({words}, i + {j}) = '{p}'" for j, p in enumerate(parts))
    return F.expr(
        f"case when size({words}) >= {len(parts)} and array_contains({words}, '{parts[0]}') "
        f"then filter(sequence(0, size({words}) - {len(parts)}), i -> {here}) else cast(array() as array<int>) end"
    )


def _literal(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def _members(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score
    (the highest containment of a template; 1 with a base phrase) and n_blocks, the blocks found."""
    sets = [(label, len(text.split()), sorted(set(text.split()))) for label, text in templates]
    needed = [math.ceil(containment * len(words)) for *_, words in sets]
    vocabulary = sorted({w for *_, words in sets for w in words})
    texts = docs.select(id_column, words_of(lowered(text_or_empty(text_column))).alias("words"))

    # One row a template word.  Any order gives the same result; blanks are enough to tell which words are rare.
    parts = docs.select(F.split(lowered(text_or_empty(text_column)), " ").alias("parts"))
    counts = parts.select(F.explode(F.expr(f"filter(parts, w -> w in ({_members(vocabulary)}))")).alias("word"))
    often = {r["word"]: r["count"] for r in counts.groupBy("word").count().collect()}
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (often.get(w, 0), w)))}
    index: dict[str, list[str]] = {}
    whole = []
    for number, ((label, n, words), least) in enumerate(zip(sets, needed, strict=True)):
        words = sorted(words, key=order.__getitem__)
        for word in words[: len(words) - least + 1]:
            index.setdefault(word, []).append(f"named_struct('t', {number}, 'n', {n})")
        whole.append(f"named_struct('label', '{label}', 'n', {n}, 'least', {least}, 'words', {_literal(words)})")
    index_sql = "map(" + ", ".join(f"'{w}', array({', '.join(of)})" for w, of in index.items()) + ")"
    whole_sql = f"array({', '.join(whole)})"

    places = {label: phrase_places("words", phrase) for phrase, label in phrases.items()}
    # Places of prefix words, then the blocks around them, each once.
    hits = F.expr(
        "filter(transform(words, (w, i) -> named_struct('w', w, 'i', i)), s -> s.w in (" + _members(sorted(index)) + "))"
    )
    blocks = F.expr(
        f"array_distinct(flatten(transform(hits, s -> flatten(transform(element_at({index_sql}, s.w), x -> "
        "filter(array(named_struct('t', x.t, 'k', s.i div x.n), named_struct('t', x.t, 'k', s.i div x.n - 1)), b -> b.k >= 0))))))"
    )
    # Of each block the template, and how many of its words the block holds; short blocks are out before.
    compared = F.expr(
        f"transform(filter(blocks, b -> size(words) - b.k * {whole_sql}[b.t].n >= {whole_sql}[b.t].least), b -> named_struct("
        f"'t', b.t, 'shared', size(array_intersect(slice(words, cast(b.k * {whole_sql}[b.t].n + 1 as int), 2 * {whole_sql}[b.t].n), "
        f"{whole_sql}[b.t].words))))"
    )
    found = F.expr(
        f"transform(filter(compared, c -> c.shared >= {whole_sql}[c.t].least), c -> named_struct('label', {whole_sql}[c.t].label, "
        f"'share', c.shared / size({whole_sql}[c.t].words)))"
    )
    rows = texts.withColumn("hits", hits).withColumn("blocks", blocks).withColumn("compared", compared).withColumn("found", found)
    rows = rows.select(
        id_column,
        F.size("words").cast("long").alias("n_words"),
        F.concat(*places.values()).alias("places"),
        F.array_compact(F.array(*[F.when(F.size(p) > 0, F.lit(label)) for label, p in places.items()])).alias("own"),
        "found",
    )
    n_base = F.size("places")
    every = F.array_union("own", F.expr("transform(found, f -> f.label)"))
    return rows.select(
        id_column,
        "n_words",
        n_base.cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort("own"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(every)), ",").alias("labels"),
        F.when(n_base > 0, 1.0).otherwise(F.coalesce(F.expr("array_max(transform(found, f -> f.share))"), F.lit(0.0))).cast("double").alias("score"),
        F.size("found").cast("long").alias("n_blocks"),
    )
