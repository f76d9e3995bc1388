"""The pipeline's stages on a small corpus, against a plain computation of each one's result."""

import zlib

import corpus_pipeline as cp
from strata.llm import secret_scan
from strata.llm.common import written
from tests.llm import nasty
from tests.llm.test_langid import speak
from tests.llm.test_minhash import brute as components
from tests.llm.test_mixing import check as check_mix, with_sizes

import strata.llm.mixing as mx


def corpus():
    rows = []
    for k in range(120):
        lang = ("en", "de", "fr")[k % 3]
        text = speak(lang, 60, k)
        if k % 10 == 4:
            text = rows[-3][1] + " und"  # a near copy
        if k % 15 == 7:
            text += f' token = "{k:08x}9f8e7d6c5b4a39281706f5e4d3c2b1a0" ' + speak(lang, 5, k)
        if k % 20 == 9:
            text = "12345 67890 " * 20  # no letters
        rows.append((k, text, lang, f"src{k % 4}", len(text)))
    return rows


def test_stages_equal_plain_computations(spark, sf_small):
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_dedup", "secret_scan", "mixing", "packing"]
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string, lang string, source string, n_chars bigint")
    stage = {n: (lambda df, f=f, n=n: written(f(spark, df, sf_small), n)) for n, f in cp.STAGES}
    spoken = stage["language_id"](docs)
    assert spoken.columns == docs.columns
    kept = {r.doc_id for r in spoken.collect()}
    assert kept == {k for k, t, *_ in corpus() if not t.startswith("12345")}
    once = stage["near_dedup"](spoken)
    assert once.columns == docs.columns
    want = components([(r.doc_id, r.text) for r in spoken.collect()])
    assert sorted(str(r.doc_id) for r in once.collect()) == sorted(d for d, _, c in want if d == c)
    assert once.count() < spoken.count()
    clean = stage["secret_scan"](once)
    assert clean.columns == docs.columns and clean.count() == once.count()
    before = {r.doc_id: r.text for r in once.collect()}
    for r in clean.collect():
        assert ("token" in before[r.doc_id]) == (secret_scan.MARK in r.text) and r.n_chars == len(r.text)
    mixed = stage["mixing"](clean)
    assert mixed.columns == docs.columns
    rows = [tuple(r) for r in clean.collect()]
    check_mix(rows, mx.mix(with_sizes(clean)).collect())
    packed = stage["packing"](mixed).collect()
    assert len({r.sequence_id for r in packed}) <= len(packed)
    tokens = sum(r.length for r in packed)
    assert len({r.sequence_id for r in packed}) <= tokens // 1024 + 3
    assert sorted(r.doc_id for r in packed if r.piece == 0) == sorted(r.doc_id for r in mixed.collect())


def test_awkward_and_empty_tables_pass_through_every_stage(spark, sf_small):
    for docs in (nasty.docs(spark), nasty.empty(spark)):
        for k, (name, stage) in enumerate(cp.STAGES):
            out = written(stage(spark, docs, sf_small), name)
            if k < len(cp.STAGES) - 1:
                assert out.columns == docs.columns
            docs = out
        docs.count()


def test_labels_of_held_out_documents_alone_reject_nothing(spark):
    ids = [k for k in range(100) if zlib.crc32(str(k).encode()) % 5 == 0][:4]
    rows = [(k, f"The words of text number {k} are plain English words.", "en", "s", 50) for k in ids] + [(999, "12345", None, "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = cp.known_language(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in rows)
