"""Licence scans: a positional index of rare words over licence templates.

Words are runs of digits, a-z and characters beyond ASCII, after lower-casing A-Z. The index holds template
positions of words that are not function words, ranked by IDF over all texts: of each template its rarest,
one more than may differ in a proposal that counts. So one of them stands at its place wherever the template
does, at any text length. Each place and posting proposes a template at a relative position. A proposal
counts when enough of the template's words stand at their places there, and its mandatory key phrase stands
in that stretch of the text.

Built-in expressions only, one row a text, no shuffle of texts; the one aggregate is the document count
of each licence word, bounded by the index vocabulary, which is why it may become a literal.

Defined cases: NULL or empty text has no words and no labels, score 0. Repeated rows each get their row.
Licence words that every text has rank last and still count: IDF decides
what is looked up, and so the cost, never the result. "All rights reserved" is a statement of rights that the
scan labels too. Extra columns are ignored. An empty table
gives no rows.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Fixed by the contract: phrase and label.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
MIN_OVERLAP = 0.7
# The score of a text with a base phrase that no template explains.
BASE_SCORE = 0.5
FUNCTION_WORDS = "the of and to in is that with for it as was on by are this or an at be a not any you may if"


class Template(NamedTuple):
    label: str
    text: str
    key: str


# Fixed values, the licences' own words: short notices by which texts name a licence, and the clauses of
# full licence texts. Variants differ by a clause of their own, or by what follows a clause they share.
TEMPLATES: tuple[Template, ...] = (
    Template("gpl", "licensed under the GNU General Public License", "general public license"),
    Template("gpl", "under the terms of the GNU General Public License as published by the Free Software Foundation",
             "general public license"),
    Template("lgpl", "licensed under the GNU Lesser General Public License", "lesser general public license"),
    Template("agpl", "licensed under the GNU Affero General Public License", "affero general public license"),
    Template("apache", "licensed under the Apache License, Version 2.0", "apache license"),
    Template("apache-2.0", "Apache License, Version 2.0", "version 2 0"),
    Template("gpl-3.0", "GNU General Public License, version 3", "gnu general public license version 3"),
    Template("gpl-2.0", "GNU General Public License, version 2", "gnu general public license version 2"),
    Template("lgpl-2.1", "GNU Lesser General Public License, version 2.1", "lesser general public license version 2 1"),
    Template("lgpl-3.0", "GNU Lesser General Public License, version 3", "lesser general public license version 3"),
    Template("agpl-3.0", "GNU Affero General Public License, version 3", "affero general public license version 3"),
    Template("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the "
             "License at http www apache org licenses LICENSE 2.0", "licenses license 2 0"),
    Template("mit", "released under the MIT License", "mit license"),
    Template("mit", "permission is hereby granted, free of charge, to any person obtaining a copy of this software "
             "and associated documentation files", "permission is hereby granted"),
    Template("mit", "to deal in the Software without restriction, including without limitation the rights to use, copy, "
             "modify, merge, publish, distribute, sublicense, and or sell copies of the Software",
             "without limitation the rights"),
    Template("mit", "the above copyright notice and this permission notice shall be included in all copies or "
             "substantial portions of the Software", "substantial portions"),
    Template("bsd", "redistribution and use in source and binary forms, with or without modification, are permitted",
             "source and binary forms"),
    Template("bsd", "licensed under the BSD License", "bsd license"),
    Template("bsd", "redistributions of source code must retain the above copyright notice, this list of conditions and "
             "the following disclaimer", "source code must retain"),
    Template("bsd", "redistributions in binary form must reproduce the above copyright notice, this list of conditions "
             "and the following disclaimer in the documentation and or other materials provided with the distribution",
             "binary form must reproduce"),
    # without a third clause, the disclaimer follows the second
    Template("bsd-2-clause", "and or other materials provided with the distribution this software is provided by the "
             "copyright holders and contributors as is", "distribution this software is provided"),
    Template("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to "
             "endorse or promote products derived from this software without specific prior written permission",
             "endorse or promote products"),
    Template("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the "
             "following acknowledgement", "advertising materials mentioning features"),
    Template("isc", "permission to use, copy, modify, and or distribute this software for any purpose with or without fee "
             "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
             "fee is hereby granted provided that"),
    Template("0bsd", "distribute this software for any purpose with or without fee is hereby granted the software is "
             "provided as is and the author disclaims all warranties", "granted the software is provided"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
    Template("zlib", "in no event will the authors be held liable for any damages arising from the use of this software",
             "will the authors be held liable"),
    Template("bsl-1.0", "Boost Software License Version 1.0", "boost software license"),
    Template("epl", "made available under the terms of the Eclipse Public License", "eclipse public license"),
    Template("epl-2.0", "Eclipse Public License v 2.0", "eclipse public license v 2 0"),
    Template("mpl-2.0", "this Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
             "mozilla public license v 2 0"),
    Template("mpl", "subject to the terms of the Mozilla Public License", "mozilla public license"),
    Template("cc-by", "licensed under CC BY 4.0", "cc by 4 0"),
    Template("cc-by-nc", "licensed under CC BY-NC 4.0", "cc by nc"),
    Template("cc-by-sa", "licensed under CC BY-SA 4.0", "cc by sa"),
    Template("cc-by-nd", "licensed under CC BY-ND 4.0", "cc by nd"),
    Template("cc-by-nc-sa", "licensed under CC BY-NC-SA 4.0", "cc by nc sa"),
    Template("cc-by", "Creative Commons Attribution 4.0 International", "commons attribution 4 0"),
    Template("cc-by-sa", "Creative Commons Attribution ShareAlike", "commons attribution sharealike"),
    Template("cc-by-nc", "Creative Commons Attribution NonCommercial", "commons attribution noncommercial"),
    Template("cc0", "CC0 1.0 Universal public domain dedication", "cc0 1 0"),
    Template("all-rights-reserved", "all rights reserved", "all rights reserved"),
)


def template_words(text: str) -> list[str]:
    return re.findall("[0-9a-z]+", text.lower())


def may_differ(n: int) -> int:
    """How many words of a template of ``n`` may differ in a proposal that counts."""
    return max(k for k in range(n + 1) if (n - k) / n >= MIN_OVERLAP)


def index(templates=TEMPLATES) -> dict[str, list[tuple[int, int]]]:
    """word -> (template, position), for words that are not function words; all words, where those are too few."""
    skip, out = set(FUNCTION_WORDS.split()), {}
    for t, template in enumerate(templates):
        words = template_words(template.text)
        telling = [(p, w) for p, w in enumerate(words) if w not in skip]
        for p, w in telling if len(telling) > may_differ(len(words)) else enumerate(words):
            out.setdefault(w, []).append((t, p))
    return out


def rarest(postings: dict[str, list[tuple[int, int]]], order: list[str], templates=TEMPLATES) -> dict[str, list[tuple[int, int]]]:
    """The postings of each template's first words in ``order``: one more than may differ."""
    left = [may_differ(len(template_words(t.text))) + 1 for t in templates]
    out = {}
    for w in order:
        for t, p in postings[w]:
            if left[t]:
                left[t] -= 1
                out.setdefault(w, []).append((t, p))
    return out


def vocabulary(templates=TEMPLATES) -> list[str]:
    return sorted(set(index(templates)) | {w for phrase, _ in BASE for w in phrase.split()})


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _with_words(docs: DataFrame, vocab: list[str]) -> DataFrame:
    words = F.regexp_extract_all(lower_ascii(F.coalesce(F.col("text"), F.lit(""))), F.lit(WORD), F.lit(0))
    df = docs.select("doc_id", words.alias("_words"))
    # one set of the vocabulary for all rows, where an array function would build it for each
    return df.withColumn("_present", F.array_distinct(F.filter("_words", lambda w: w.isin(vocab))))


def idf(docs: DataFrame, templates=TEMPLATES) -> dict[str, float]:
    """IDF of each licence word over all texts: as many rows as the vocabulary has words, at most."""
    found = _with_words(docs, vocabulary(templates)).select(F.explode(F.array_append("_present", F.lit(""))).alias("w"))
    counts = {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count("*").alias("n")).collect()}
    n = counts.pop("", 0)  # the empty word stands once in each text
    return {w: math.log((n + 1) / (counts.get(w, 0) + 1)) for w in vocabulary(templates)}


def _places(phrase: str) -> Column:
    """Starts of the phrase's words standing consecutively, looked for only where all of them occur."""
    words = phrase.split()
    w = F.col("_words")

    def starts(i: Column) -> Column:
        same = F.get(w, i) == words[0]
        for k, x in enumerate(words[1:], 1):
            same = same & (F.get(w, i + k) == x)
        return same

    all_there = F.size(F.array_intersect(F.col("_present"), _strings(words))) == len(set(words))
    found = F.filter(F.sequence(F.lit(0), F.size(w) - len(words)), starts)
    return F.when(all_there & (F.size(w) >= len(words)), found).otherwise(F.array().cast("array<int>"))


# A proposal is one long: template number, then the start shifted so that it is positive.
_SHIFT, _LOW = 40, 1 << 20


def _proposals(postings: dict[str, list[tuple[int, int]]]) -> tuple[Column, Column]:
    """The words to look up, and the templates at relative positions, that their places propose."""
    rare = F.array_intersect(F.col("_present"), _strings(list(postings)))
    places = F.filter(
        F.transform("_words", lambda w, i: F.when(F.array_contains("_rare", w), F.struct(w.alias("w"), i.alias("i")))),
        lambda x: x.isNotNull(),
    )
    entries = F.create_map(
        *[
            c
            for w, found in postings.items()
            for c in (F.lit(w), F.array(*[F.lit((t << _SHIFT) + _LOW - p).cast("bigint") for t, p in found]))
        ]
    )
    each = F.transform(places, lambda x: F.transform(F.element_at(entries, x["w"]), lambda base: base + x["i"]))
    return rare, F.array_distinct(F.flatten(each))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches."""
    postings, weights = index(templates), idf(docs, templates)
    order = sorted(postings, key=lambda w: (-weights[w], w))
    rare, proposals = _proposals(rarest(postings, order, templates))
    bodies = F.array(*[_strings(template_words(t.text)) for t in templates])
    keys = _strings([f" {t.key} " for t in templates])
    labels = _strings([t.label for t in templates])
    w = F.col("_words")

    def judge(x: Column) -> Column:
        t = F.shiftright(x, _SHIFT).cast("int")
        start = (x.bitwiseAND((1 << _SHIFT) - 1) - _LOW).cast("int")
        body = F.get(bodies, t)
        n = F.size(body)
        hits = F.size(F.filter(F.sequence(F.lit(0), n - 1), lambda p: F.get(w, start + p) == F.get(body, p)))
        # the stretch of the text that the template covers
        begin = F.greatest(start, F.lit(0))
        stretch = F.concat(F.lit(" "), F.array_join(F.slice(w, begin + 1, n + F.least(start, F.lit(0))), " "), F.lit(" "))
        return F.struct(
            F.get(labels, t).alias("label"), (hits / n).alias("overlap"), begin.alias("start"),
            F.contains(stretch, F.get(keys, t)).alias("has_key"),
        )

    df = _with_words(docs, vocabulary(templates))
    df = df.withColumns({f"_base{k}": _places(phrase) for k, (phrase, _) in enumerate(BASE)} | {"_rare": rare})
    none = F.array().cast("array<bigint>")
    df = df.withColumn("_proposals", F.when(F.size("_rare") > 0, proposals).otherwise(none))
    df = df.withColumn("_judged", F.transform("_proposals", judge))
    df = df.withColumn("_found", F.filter("_judged", lambda m: (m["overlap"] >= MIN_OVERLAP) & m["has_key"]))
    places = F.concat(*[F.col(f"_base{k}") for k in range(len(BASE))])
    base = F.filter(
        F.array(*[F.when(F.size(f"_base{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE)]),
        lambda x: x.isNotNull(),
    )
    df = df.withColumns({"_places": places, "_base": base})
    best = F.coalesce(F.array_max(F.transform("_found", lambda m: m["overlap"])), F.lit(0.0))
    floor = F.when(F.size("_base") > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0))
    every = F.array_distinct(F.concat(F.col("_base"), F.transform("_found", lambda m: m["label"])))
    return df.select(
        "doc_id",
        F.size("_words").cast("bigint").alias("n_words"),
        F.size("_places").cast("bigint").alias("n_base"),
        F.array_min("_places").cast("bigint").alias("first_word"),
        F.array_max("_places").cast("bigint").alias("last_word"),
        F.array_join(F.sort_array("_base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(every), ",").alias("labels"),
        F.greatest(best, floor).alias("score"),
        F.size("_found").cast("bigint").alias("matches"),
    )
