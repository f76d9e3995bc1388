"""A small documents table with every awkward case, and an empty one."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, _row string, KEPT string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int, words=WORDS) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(words) + str(r.randrange(50)) + ("." if k % 9 == 8 else "") for k in range(n))


def rows() -> list[tuple]:
    long = prose(1, 30_000)
    base = prose(2, 200)
    near = base.replace("alpha", "ALPHA") + " extra words at the end"
    texts = [
        (1, base, "en", "a"), (2, near, "en", "a"), (3, base, None, "b"), (3, base, None, "b"),  # a repeated row
        (4, None, "en", "b"), (5, "", "en", None), (6, " \t\n ", "en", None), (7, "one", "en", "b"),
        (8, "Two\twords", "de", "c"), (9, "two  WORDS", "de", "c"), (10, long, "en", "é"),
        (11, "12345 67890 !!! ###", "en", "c"), (12, "ß ünïcödé 漢字 \U0001f600 " * 30, "de", "c"),
        (None, prose(3, 60), "en", "a"), (13, prose(4, 60) + "\n" + prose(4, 60), "en", "a"),
        (14, "x" * 5000, "en", "d"), (15, "same same same " * 40, "en", "d"), (5, "another text of five", "en", None),
    ]
    return [(i, t, lang, s, len(t) if t is not None else None, 99, "row", "kept") for i, t, lang, s in texts]


def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
