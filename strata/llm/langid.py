"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts hashed 1- to 3-grams of letters for each language, summed by Spark from partial
counts; the log-probability matrix (languages x ``N_BUCKETS``) is broadcast, and whole texts are
scored in batches by numpy: gather the matrix rows of a batch's n-grams, sum them for each document.

Bounds: at most ``MAX_LANGUAGES`` languages (checked), so the matrix has at most 128 MB. Memory in a
task follows ``CHUNK`` characters, not the text: long texts are scored slice by slice.

Defined cases: NULL text and text without a letter are ``und`` with score 0. A NULL lang never teaches.
Without any labelled text everything is ``und``. Equal posteriors go to the language that sorts
first. A NULL doc_id counts as held out. Repeated rows each teach and each get a row. Extra columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ship

N_BUCKETS = 1 << 16
MAX_LANGUAGES = 256
ALPHA = 0.1
FOLDS = 5
# Numbers gathered at a time: characters times languages stay below four times this.
CHUNK = 1 << 19
SLICE = 1 << 18
UNKNOWN = "und"
# Document counts travel with the n-gram counts, under this bucket.
DOCS = -1

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Code point to its lower-case letter, or to a blank; built once in each Python worker."""
    global _letters
    if _letters is None:
        codes = np.full(0x110000, 32, dtype=np.uint32)
        for c in range(0x30000):  # letters beyond are unassigned or ideographs without case
            ch = chr(c)
            if ch.isalpha():
                codes[c] = ord(ch.lower()[0])
        beyond = np.arange(0x30000, 0x323B0, dtype=np.uint32)
        codes[beyond] = beyond
        _letters = codes
    return _letters


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _slices(texts: Iterator[str | None], most: int) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of (document number, piece); a piece is followed by the two characters it looks ahead to."""
    at, pieces, n = [], [], 0
    for k, text in enumerate(texts):
        if not text:
            continue
        text = f" {text}"
        for i in range(0, len(text), SLICE):
            piece = text[i : i + SLICE + 2]
            end = i + SLICE >= len(text)
            # the last piece looks ahead to blanks; one that ends just short of the text has them cut off
            at.append(k)
            pieces.append(text[i:] + "  " if end else piece + " " * (SLICE + 2 - len(piece)))
            n += len(piece)
            if n >= most:
                yield at, pieces
                at, pieces, n = [], [], 0
    if pieces:
        yield at, pieces


def _grams(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the n-grams of the pieces, and the piece of each; and the letters of each piece."""
    lengths = np.array([len(p) for p in pieces])
    codes = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c = letters()[np.minimum(codes, 0x10FFFF)]
    owner = np.repeat(np.arange(len(pieces)), lengths)
    ends = np.cumsum(lengths)
    starts = np.ones(len(c), dtype=bool)
    starts[ends - 1] = starts[ends - 2] = False
    is_letter = c != 32
    pos = np.flatnonzero(starts)
    one, two, three = c[pos], c[np.minimum(pos + 1, len(c) - 1)], c[np.minimum(pos + 2, len(c) - 1)]
    first, second = is_letter[pos], two != 32
    h1 = one * np.uint32(0x9E3779B1)
    h2 = (h1 ^ two) * np.uint32(0x85EBCA77)
    h3 = (h2 ^ three) * np.uint32(0xC2B2AE3D)
    own = owner[pos]
    keep = (first, first | second, second)
    buckets = np.concatenate([(h[k] >> np.uint32(16)).astype(np.int32) for h, k in zip((h1, h2, h3), keep)])
    owners = np.concatenate([own[k] for k in keep])
    return buckets, owners, np.bincount(own[first], minlength=len(pieces))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, bucket, n) of the partition: one row at most for each language and bucket."""
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        for lang, texts in batch.groupby("lang", sort=False)["text"]:
            total = counts.setdefault(lang, np.zeros(N_BUCKETS, dtype=np.int64))
            docs[lang] = docs.get(lang, 0) + len(texts)
            for _, pieces in _slices(iter(texts), CHUNK):
                total += np.bincount(_grams(pieces)[0], minlength=N_BUCKETS)
    for lang, total in counts.items():
        at = np.flatnonzero(total)
        yield pd.DataFrame({"lang": lang, "bucket": np.append(at, DOCS), "n": np.append(total[at], docs[lang])})


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and log prior and log probabilities: an array of (N_BUCKETS + 1) x languages."""
    ship(labelled.sparkSession)
    counts = (
        labelled.select("lang", "text").filter("lang is not null and text is not null")
        .mapInPandas(_count, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )
    # at most one array for each language: the size is bounded before anything is collected
    rows = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("v"))
    found = rows.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    found.sort(key=lambda r: r["lang"])
    model = np.zeros((N_BUCKETS + 1, len(found)))
    for k, r in enumerate(found):
        n = np.zeros(N_BUCKETS + 1)
        v = np.array(r["v"], dtype=np.int64)
        n[v[:, 0]] = v[:, 1]  # DOCS = -1 lands in the last place
        model[:-1, k] = np.log((n[:-1] + ALPHA) / (n[:-1].sum() + ALPHA * N_BUCKETS))
        model[-1, k] = n[-1]
    if len(found):
        model[-1] = np.log(model[-1] / model[-1].sum())
    return [r["lang"] for r in found], model


def scored(texts: pd.Series, langs: list[str], model: np.ndarray) -> pd.DataFrame:
    """lang_pred and the posterior of that language, for each text."""
    total = np.zeros((len(texts), max(1, len(langs))))
    seen = np.zeros(len(texts), dtype=np.int64)
    most = max(1 << 12, 4 * CHUNK // max(4, len(langs)))
    for at, pieces in _slices(iter(texts), most):
        buckets, owners, n_letters = _grams(pieces)
        docs = np.array(at)
        np.add.at(seen, docs, n_letters)
        for k in range(len(langs)):
            np.add.at(total[:, k], docs, np.bincount(owners, weights=model[buckets, k], minlength=len(pieces)))
    if not langs:
        return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0})
    total += model[-1]
    best = total.argmax(axis=1)
    p = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    names = np.array(langs, dtype=object)[best]
    return pd.DataFrame({"lang_pred": np.where(seen > 0, names, UNKNOWN), "score": np.where(seen > 0, p, 0.0)})


def predict(docs: DataFrame, langs: list[str], model: np.ndarray, out: str) -> DataFrame:
    """``docs`` with ``out``: a struct of lang_pred and score. The text alone goes to Python."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield scored(texts, langs, shared.value)

    return docs.withColumn(out, language(F.col("text")))


def language_id(docs: DataFrame, out: str = "_language") -> DataFrame:
    """Learns from the labelled documents that aren't held out, and predicts for every one."""
    langs, model = train(docs.filter(~held_out(F.col("doc_id"))))
    return predict(docs, langs, model, out)
