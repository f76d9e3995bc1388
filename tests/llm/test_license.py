import re

from strata.llm import license_scan as ls
from tests.llm import nasty

TEXTS = [
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "mit LICENSE mit license",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
    "gnu general public", "license mit", "a mit-license b", "é mit é license", "apache  license\ncc\tby",
    "licensed under something else, released in the open, version 3", "All rights reserved.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this thing and associated files",
]


def brute(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    places, labels = [], set()
    for phrase, label in ls.BASE:
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_equals_brute_force(spark):
    df = nasty.docs(spark).select("doc_id", "text").union(spark.createDataFrame(list(enumerate(TEXTS, 100))))
    got = [tuple(r[1:6]) for r in ls.scan(df).collect()]
    assert sorted(map(repr, got)) == sorted(repr(brute(r.text)) for r in df.collect())


def test_templates_are_found_at_their_place_with_their_key_phrase(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    got = {r.doc_id: r for r in ls.scan(df).collect()}
    assert got[0].labels == "mit" and got[0].score == 1.0
    assert got[1].labels == "apache,apache-2.0"
    assert got[3].labels == "gpl,gpl-3.0"
    assert got[4].labels == "cc-by,cc-by-nc"
    assert got[11].labels == "all-rights-reserved" and got[11].base_labels == ""
    assert got[12].labels == "mit" and ls.MIN_OVERLAP <= got[12].score < 1.0  # two words differ
    assert got[2].n_base == 2 and got[2].labels == "mit"
    assert got[10].labels == "" and got[5].labels == "" and got[5].score == 0.0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. """
BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission. """
DISCLAIMER = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES'
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES"""
FULL = {
    MIT: "mit", BSD_2 + DISCLAIMER: "bsd,bsd-2-clause", BSD_2 + BSD_3 + DISCLAIMER: "bsd,bsd-3-clause", ISC: "isc",
    ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", ""): "0bsd",
    "Licensed under the GNU Lesser General Public License, version 2.1": "lgpl,lgpl-2.1",
    "the GNU Lesser General Public License, version 3": "lgpl,lgpl-3.0",
    "the GNU Affero General Public License, version 3": "agpl,agpl-3.0",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl,mpl-2.0",
    "This is free and unencumbered software released into the public domain.": "unlicense",
    "Creative Commons Attribution-ShareAlike 4.0": "cc-by-sa",
    "Creative Commons Attribution 4.0 International": "cc-by",
}


def test_full_texts_and_variants_are_told_apart(spark):
    around = nasty.prose(1, 40)
    df = spark.createDataFrame([(k, f"{around}\n{t}\n{around}") for k, t in enumerate(FULL)], "doc_id int, text string")
    got = {r.doc_id: r.labels for r in ls.scan(df).collect()}
    assert got == dict(enumerate(FULL.values()))


def brute_templates(text):
    """Label and start of every place where enough of a template's words stand, and its key phrase."""
    w, out = re.findall("[0-9a-z]+", text.lower()), set()
    for t, template in enumerate(ls.TEMPLATES):
        body = ls.template_words(template.text)
        for start in range(-len(body), len(w)):
            there = [w[start + p] if 0 <= start + p < len(w) else None for p in range(len(body))]
            stretch = " ".join(["", *filter(None, there), ""])
            if sum(map(str.__eq__, body, map(str, there))) / len(body) >= ls.MIN_OVERLAP and f" {template.key} " in stretch:
                out.add((t, template.label, start))
    return out


def test_texts_with_many_licences_keep_every_template(spark):
    every = [t.text for t in ls.TEMPLATES]
    common = " all use software free public version 2 3 4 0 by universal terms person copy form source "
    texts = [". Other words. ".join(every), common * 50 + " -- ".join(reversed(every)) + common * 50, " ".join(TEXTS)]
    texts += [f"{common} {t} {common}" for t in every]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in ls.scan(df).collect()}
    for k, text in enumerate(texts):
        want = brute_templates(text)
        assert got[k].matches == len(want)
        labels = {label for _, label, _ in want} | set(filter(None, got[k].base_labels.split(",")))
        assert got[k].labels == ",".join(sorted(labels))
    assert set(got[0].labels.split(",")) >= {t.label for t in ls.TEMPLATES}


def test_empty_table_and_extra_columns(spark):
    assert ls.scan(nasty.empty(spark)).count() == 0
    assert ls.scan(nasty.docs(spark)).count() == len(nasty.rows())
    assert "Python" not in ls.scan(nasty.docs(spark))._jdf.queryExecution().executedPlan().toString()
