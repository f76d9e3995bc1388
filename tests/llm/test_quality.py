import re
from collections import Counter

from strata.llm import quality
from tests.llm import nasty


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
        len(covered),
    )


def test_base_counts_equal_brute_force_on_awkward_texts(spark):
    extra = ["a b c a b c a b c", "a b a b a", "x\n\nx\n x\nx", "# * $ % & | < > # #", "a b c d a b c", "p q r p q r s"]
    df = nasty.docs(spark).select("doc_id", "text").union(spark.createDataFrame([(100 + k, t) for k, t in enumerate(extra)]))
    want = sorted(brute(r.text) for r in df.collect())
    got = quality.quality_rules(df).collect()
    assert sorted(tuple(r[1:6]) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.failed_rules == "")


def test_long_text_path_counts_alike(spark, monkeypatch):
    monkeypatch.setattr(quality, "POSITION_BITS", 3)  # texts of 8 words or more take the other path
    df = spark.createDataFrame([(1, "a b c d e a b c x y z a b c"), (2, "a b a b a b"), (3, "q w e r t y u i o p")], "doc_id int, text string")
    assert sorted(r.n_repeat_words for r in quality.quality_rules(df).collect()) == sorted(brute(r.text)[4] for r in df.collect())


def test_a_rule_of_the_table_decides(spark):
    good = "the way of the text is that it goes on and on with words such as these, and " + nasty.prose(9, 60)
    df = spark.createDataFrame([(1, good), (2, good.replace(" ", " # "))], "doc_id int, text string")
    got = {r.doc_id: r for r in quality.quality_rules(df).collect()}
    assert got[1].kept and not got[2].kept and "symbols" in got[2].failed_rules


def test_windows_that_share_a_hash_are_counted_by_their_words(spark, monkeypatch):
    # five bits of hash remain, so that many different windows share one
    monkeypatch.setattr(quality, "POSITION_BITS", 58)
    texts = [" ".join(f"w{(k * s) % 23}" for k in range(60)) for s in range(1, 12)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert {r.doc_id: r.n_repeat_words for r in quality.quality_rules(df).collect()} == {k: brute(t)[4] for k, t in enumerate(texts)}


def test_stop_words_are_a_share_and_judge_known_languages_only(spark):
    prose = " ".join(f"ord{k}" for k in range(70))
    stops = "the of and to " * 2 + prose
    rows = [(1, prose, "en"), (2, prose, None), (3, prose, "sv"), (4, stops, "en"), (5, "the of " + prose, "EN-gb"), (6, prose, "EN-gb")]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    got = {r.doc_id: r.failed_rules for r in quality.quality_rules(df).collect()}
    # 8 of 78 words are enough, two different ones among 72 are not
    assert got == {1: "stop_words", 2: "stop_words", 3: "", 4: "", 5: "stop_words", 6: "stop_words"}
    assert {r.failed_rules for r in quality.quality_rules(df.drop("lang").filter("doc_id = 3")).collect()} == {"stop_words"}
    assert sorted(r.doc_id for r in quality.keep_good(df).collect()) == [3, 4]


def test_keep_good_keeps_rows_and_columns(spark):
    df = nasty.docs(spark)
    kept = quality.keep_good(df, rules=())
    assert kept.columns == df.columns
    assert kept.count() == quality.quality_rules(df, rules=()).filter("kept").count() > 0
    assert quality.keep_good(nasty.empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = quality.quality_rules(nasty.docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange hash" not in plan
