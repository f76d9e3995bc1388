import hashlib
import random
import re

import pytest

from strata.llm import decontaminate as D
from tests.llm import nasty

ITEMS = "item_id bigint, text string, window string, doc_id int"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, listed = words(text), set(), set()
        for window, which in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    listed |= which
        named = sorted(str(i) for i in listed if i is not None)
        out.append((doc_id, len(w), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def benchmark(spark):
    base = nasty.prose(2, 200).split()
    texts = [
        (1, " ".join(base[20:50])), (2, " ".join(base[30:34])), (2, " ".join(base[30:34])), (3, None), (4, " ?! "),
        (5, "ONE"), (10, " ".join(base[30:45]).upper()), (None, " ".join(base[100:112])), (6, "12345-67890"),
        (7, "ß ünïcödé 漢字 ß ünïcödé 漢字 ß ünïcödé 漢字 ß ünïcödé 漢字"), (8, "same same"), (9, "never found here at all"),
    ]
    return spark.createDataFrame([(*t, "x", 1) for t in texts], ITEMS)


def pairs(df, key):
    return [(r[key], r["text"]) for r in df.collect()]


@pytest.mark.parametrize("chars", [D.BLOCK_CHARS, 400])
def test_awkward_rows_equal_brute_force_in_one_block_and_in_many(spark, monkeypatch, chars):
    monkeypatch.setattr(D, "BLOCK_CHARS", chars)
    items, docs = benchmark(spark), nasty.docs(spark)
    assert (D.blocks(D.windows(items))[1] > 3) == (chars == 400)
    got = sorted(map(tuple, D.contaminated(docs, items).collect()), key=str)
    assert got == brute(pairs(docs, "doc_id"), pairs(items, "item_id"))
    assert sum(r[-1] for r in got) >= 6


def test_random_overlapping_windows_equal_brute_force(spark):
    r = random.Random(4)
    text = lambda n: " ".join(r.choice("abc") for _ in range(n))
    docs = spark.createDataFrame([(k, text(r.randrange(60))) for k in range(60)], "doc_id int, text string")
    items = spark.createDataFrame([(k, text(r.choice([3, 5, 8, 12, 14]))) for k in range(40)], "item_id int, text string")
    got = sorted(map(tuple, D.contaminated(docs, items).collect()), key=str)
    assert got == brute(pairs(docs, "doc_id"), pairs(items, "item_id"))


def test_spans_are_places_of_the_original(spark):
    leak = "Which planet, of all those known, has the MOST moons (as counted)?"
    docs = spark.createDataFrame([(1, f"Intro...\n{leak} The end"), (2, "clean")], "doc_id int, text string")
    rows = D.contamination(docs, spark.createDataFrame([(3, leak.lower())], "item_id int, text string")).collect()
    [span] = rows[0]._leaks.spans
    assert rows[0].text[span.begin : span.end] == leak.rstrip(")?") and rows[1]._leaks.spans == []
    assert (span.first_word, span.last_word, rows[0]._leaks.items) == (1, 12, ["3"])


def test_empty_tables_and_clashing_names(spark):
    docs, items = nasty.docs(spark), benchmark(spark)
    none = spark.createDataFrame([], ITEMS)
    assert not any(r.contaminated for r in D.contaminated(docs, none).collect())
    assert D.contaminated(nasty.empty(spark), items).count() == 0
    with pytest.raises(ValueError):
        D.contamination(docs.withColumn("_LEAKS", docs.doc_id), items)
    kept = D.without_contaminated(docs.withColumn("_LEAKS", docs.doc_id), items)
    assert kept.columns == [*docs.columns, "_LEAKS"]
    assert kept.count() == sum(not r[-1] for r in brute(pairs(docs, "doc_id"), pairs(items, "item_id")))
