import random
import zlib

import numpy as np

from strata.llm import langid as li
from tests.llm import nasty

TONGUES = {
    "en": "the and of that this with from ing tion er th wh ly ed".split(),
    "de": "der die und das ein ung heit keit sch ich für über ver zu".split(),
    "fr": "le la les des est une que eau eux ment tion pour é è".split(),
}


def speak(lang, n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice(TONGUES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


def table(spark, n=400):
    rows = []
    for k in range(n):
        lang = list(TONGUES)[k % 3]
        rows.append((k, speak(lang, 8 + k % 50, k), lang))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), rows


def test_held_out_accuracy_and_folds(spark):
    df, rows = table(spark)
    out = li.language_id(df).select("doc_id", li.held_out(df.doc_id).alias("held"), "_language.*").collect()
    truth = {k: lang for k, _, lang in rows}
    test = [r for r in out if r.held]
    assert len(out) == len(rows) and len(test) > 40
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert sum(r.lang_pred == truth[r.doc_id] for r in test) / len(test) > 0.98
    assert all(0 <= r.score <= 1 for r in out)


def grams(text):
    """Buckets of a text's n-grams, one window at a time."""
    c = li.letters()
    codes = [int(c[ord(x)]) for x in f" {text}  "]
    out = []
    for i in range(len(codes) - 2):
        one, two, three = codes[i : i + 3]
        h1 = one * 0x9E3779B1 & 0xFFFFFFFF
        h2 = (h1 ^ two) * 0x85EBCA77 & 0xFFFFFFFF
        h3 = (h2 ^ three) * 0xC2B2AE3D & 0xFFFFFFFF
        out += [h >> 16 for h, keep in ((h1, one != 32), (h2, one != 32 or two != 32), (h3, two != 32)) if keep]
    return out


def test_counts_and_scores_equal_brute_force(spark, monkeypatch):
    rows = [(1, "Ab ä!", "x"), (2, None, "x"), (6, "zz zz", "y"), (7, "漢字 \U0001f600 b", "y"), (8, "", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    langs, model = li.train(df)
    assert langs == ["x", "y"]
    want = np.zeros((li.N_BUCKETS, 2))
    for _, text, lang in rows:
        if text and lang:
            np.add.at(want[:, langs.index(lang)], grams(text), 1)
    want = np.log((want + li.ALPHA) / (want.sum(axis=0) + li.ALPHA * li.N_BUCKETS))
    assert np.allclose(model[:-1], want)
    assert np.allclose(np.exp(model[-1]), [1 / 3, 2 / 3])
    import pandas as pd

    got = li.scored(pd.Series(["Ab", None, "12 !", "zz"]), langs, model)
    assert list(got.lang_pred) == ["x", "und", "und", "y"] and list(got.score[1:3]) == [0.0, 0.0]
    total = model[grams("Ab")].sum(axis=0) + model[-1]
    assert abs(got.score[0] - 1 / (1 + np.exp(total[1] - total[0]))) < 1e-9


def test_slices_of_a_long_text_give_the_same_counts(monkeypatch):
    text = speak("de", 300, 1)
    whole = np.bincount(grams(text), minlength=li.N_BUCKETS)
    for size in (1, 2, 7, 64):
        monkeypatch.setattr(li, "SLICE", size)
        total = sum(np.bincount(li._grams(p)[0], minlength=li.N_BUCKETS) for _, p in li._slices(iter([text]), 50))
        assert (total == whole).all()


def test_awkward_tables(spark):
    out = li.language_id(nasty.docs(spark)).select("doc_id", "_language.*").collect()
    assert len(out) == len(nasty.rows())
    by = {r.doc_id: r for r in out}
    assert by[4].lang_pred == "und" and by[6].lang_pred == "und" and by[11].lang_pred == "und"
    assert li.language_id(nasty.empty(spark)).count() == 0
    unlabelled = li.language_id(nasty.docs(spark).drop("lang").selectExpr("*", "cast(null as string) lang"))
    assert {r.lang_pred for r in unlabelled.select("_language.*").collect()} == {"und"}
