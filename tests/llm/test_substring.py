import re

from strata.llm import substring as sb
from tests.llm import nasty


def brute(rows, least=sb.MIN_WORDS):
    """(doc_id, start, length, first doc_id) of each unit that goes, one document after the other."""
    cut = re.compile(r"\n|(?<=[.!?…])[ \t]+")
    texts = []
    for row, (i, text) in enumerate(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))):
        at, found = 0, []
        for m in [*cut.finditer(text or ""), None]:
            end = m.start() if m else len(text or "")
            words = (text or "")[at:end].lower().split()
            if words:
                found.append((at, end - at, " ".join(words), len(words)))
            at = m.end() if m else end
        texts.append((i, found))
    seen, out = {}, []
    for i, found in texts:
        run = []
        for unit in [*found, None]:
            if unit and unit[2] in seen:
                run.append((i, unit[0], unit[1], seen[unit[2]], unit[3]))
                continue
            if sum(u[4] for u in run if u[4] >= sb.UNIT_WORDS) >= least:
                out += [u[:4] for u in run]
            run = []
            if unit:
                seen[unit[2]] = i
    return sorted(map(str, out))


def rows():
    passage = ". ".join(nasty.prose(50 + k, 13).replace(".", "") for k in range(5)) + "."
    short = "A heading that stands in many texts."
    out = [(r[0], r[1]) for r in nasty.rows() if r[0] not in (3, 5)]
    out += [(200 + k, f"{nasty.prose(300 + k, 40)}\n{short}\n{nasty.prose(400 + k, 20)}") for k in range(6)]
    out += [(300 + k, f"{nasty.prose(500 + k, 30)} end. {passage} {nasty.prose(600 + k, 30)}") for k in range(4)]
    return out + [(310, f"{passage}\n{passage}")]


def test_removed_units_equal_brute_force(spark):
    df = spark.createDataFrame(rows(), "doc_id bigint, text string").repartition(3)
    got = sb.repeated_units(df).collect()
    assert sorted(str((r.doc_id, r.start, r.length, r.first_doc_id)) for r in got) == brute(rows())
    ids = {r.doc_id for r in got}
    assert {301, 302, 303, 310} <= ids and not ids & {200 + k for k in range(6)}  # the heading alone stays


def test_kept_spans_are_the_text_that_is_left(spark):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows()], "doc_id bigint, text string, kept_spans string, n_chars int, units string")
    out = sb.without_repeats(df)
    assert out.columns[:-1] == df.columns and out.columns[-1] != "kept_spans"
    texts = dict((str(i), t) for i, t in rows())
    got = out.collect()
    assert len(got) == len(rows())
    for r in got:
        text = texts[str(r.doc_id)]
        left = "".join(text[s.start : s.start + s.length] for s in r[-1]) if text is not None else None
        assert r.text == left and (text is None or r.n_chars == len(left))
    first = next(r for r in got if r.doc_id == 300)
    assert first.text == texts["300"]  # the earliest occurrence stays


def test_every_long_passage_shared_by_two_documents_is_caught(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    caught = {r.doc_id for r in sb.repeated_units(docs).select("doc_id").distinct().collect()}
    seen, shared = {}, {}
    for r in docs.orderBy("doc_id").collect():
        words = r.text.lower().split()
        for i in range(len(words) - 79):
            key = tuple(words[i : i + 80])
            if len(set(key)) > 20 and seen.setdefault(key, r.doc_id) != r.doc_id:
                shared.setdefault(r.doc_id, 0)
                shared[r.doc_id] += 1
    assert shared and len(set(shared) - caught) <= 0.02 * len(shared)


def test_awkward_tables(spark):
    assert sb.repeated_units(nasty.empty(spark)).count() == 0
    assert sb.without_repeats(nasty.empty(spark)).count() == 0
    out = sb.repeated_units(nasty.docs(spark)).collect()
    assert {r.doc_id for r in out} >= {3}


def test_passages_of_short_units_go(spark):
    lines = "\n".join(f"line {k} of list {k % 7}" for k in range(12))  # 60 words, five a line
    said = " ".join(f"Number {k} it is." for k in range(8))  # 32 words, four a sentence
    few = " ".join(f"Only {k} here." for k in range(8))  # 24 words
    rows = [(1, lines), (2, f"{nasty.prose(1, 30)}\n{lines}"), (3, said), (4, f"{nasty.prose(2, 30)} end. {said}"), (5, few), (6, few)]
    got = sb.repeated_units(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    words = {}
    for r in got:
        words[r.doc_id, r.first_doc_id] = words.get((r.doc_id, r.first_doc_id), 0) + r.words
    assert words == {(2, 1): 60, (4, 3): 32}


def test_every_whole_unit_passage_of_51_words_is_caught(spark, sf_small):
    """Consecutive whole units, 51 words or more, that stand so in an earlier document: none may stay."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    caught = {(r.doc_id, r.start) for r in sb.repeated_units(docs).select("doc_id", "start").collect()}
    seen, missed, n = {}, set(), 0
    cut = re.compile(r"\n|(?<=[.!?…])[ \t]+")
    for r in docs.orderBy("doc_id").collect():
        ends = [*((m.start(), m.end()) for m in cut.finditer(r.text)), (len(r.text),) * 2]
        starts = [0, *(after for _, after in ends)]
        units = [(at, r.text[at:end].lower().split()) for at, (end, _) in zip(starts, ends)]
        units = [u for u in units if u[1]]
        for i in range(len(units)):
            words, j = [], i
            while j < len(units) and len(words) < 51:
                words, j = words + units[j][1], j + 1
            if len(words) < 51:
                break
            key = tuple(tuple(u) for _, u in units[i:j])
            if seen.setdefault(key, r.doc_id) != r.doc_id:
                n += 1
                missed |= {(r.doc_id, at) for at, _ in units[i:j]} - caught
    assert n and not missed
