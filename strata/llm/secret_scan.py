"""Secret scans: candidates by pattern, false positives removed by a random forest.

Candidates are assignments to a credential word, user and password in an address, bodies of private key
blocks, keys of known prefixes, and runs of 16 or more key characters with a digit anywhere in them.
A random forest judges each by its length, character transitions, dictionary coverage, the document's
path and the neighbouring words. It learns from labelled findings: the caller's, or else the ones with
known truth of ``secret_findings``, which are made independently of any rule here. Training takes at most
``MAX_TRAINING`` findings of each label, those with the smallest hashes; every candidate of every whole text
is scored.

Built-in expressions and Spark ML only. A text's offsets come from splitting it at its candidates.

Defined cases: NULL or empty text has no candidate. Assigned values and passwords in addresses count from six
characters on; bare ones without a digit, without a known prefix and shorter than 16 characters are no candidates,
as they can't be told from words. Repeated rows give repeated findings. With a caller's labels of one kind
only there is no forest, and every finding is what that label says. NULL path counts as no path. Extra
columns are dropped by ``scan`` and kept by ``redacted``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import documents_like, free_name, written
from strata.llm.secret_findings import labelled_texts

CREDENTIAL_WORDS = "password passwd pwd secret token apikey api_key api-key access_key access-key auth_key credential"
PLACEHOLDERS = "example sample dummy fake test your changeme placeholder xxxx todo redacted null none"
DIGEST_WORDS = "sha1 sha256 md5 commit checksum digest hash uuid build version revision"
DICTIONARY = (
    "the and for with that this from have not you are all can will one has more when who what some time out "
    "http https www com org net html index page file path name user admin root data value string number image "
    "der die das und ist mit von den les des une est pour dans que los las por con una para "
    "tion ment ing ung able heit keit eaux cion ando"
)
# Pairs of letters that make up most of running text; keys hold few of them.
COMMON_PAIRS = (
    "th he in er an re nd at on nt ha es st en ed to it ou ea hi is or ti as te et ng of al de se le sa si ar ve ra ld ur "
    "ro ri io ne me li ll ce co la ma el ic om pe di ec om us ow un ta na ho so wo ot ee ss pl lo mo ch ie ei no wi"
)
TEST_PATHS = "test example sample mock fixture demo doc"

_KEY = r"A-Za-z0-9+/_=.\-"
_WORDS = "|".join(CREDENTIAL_WORDS.split())
_NAME = r"A-Za-z0-9_.\-"
# from a name's beginning on, so that access_token = ... is an assignment as a whole
_ASSIGNED = rf"(?<![{_NAME}])[{_NAME}]*?(?i:{_WORDS})(?i:[_\-]?(?:key|value))?[\"']?[ \t]{{0,3}}[:=]{{1,2}}[ \t]{{0,3}}[\"']?"
_HEAD = r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----[\s\\]*"
_BLOCK = rf"{_HEAD}[A-Za-z0-9+/=\s\\]++(?=-----END)"
_USER = r"[^\s:/?#@\"']*+:"
_ADDRESS = rf"(?<=://){_USER}[^\s@/\"']{{6,}}+(?=@)"
_PREFIX = r"(?:gh[pousr]_|sk_live_|rk_live_|xox[abpr]-|glpat-|AKIA|ASIA)"
_PREFIXED = rf"(?<![{_KEY}]){_PREFIX}[A-Za-z0-9_\-]{{16,}}+"
# looks as far as the run goes; a run is looked at from its beginning only
_OPAQUE = rf"(?<![{_KEY}])(?=[A-Za-z+/_=.\-]*+[0-9])[{_KEY}]{{16,}}+"
CANDIDATE = rf"{_BLOCK}|{_ADDRESS}|{_ASSIGNED}[^\s\"']{{6,}}+|{_PREFIXED}|{_OPAQUE}"
CONTEXT = 60

MAX_TRAINING = 10_000
TREES, DEPTH, SEED = 32, 10, 7
THRESHOLD = 0.5
MARK = "[SECRET]"

FEATURES: tuple[str, ...] = (
    "length", "digit_share", "upper_share", "other_share", "kind_changes", "case_changes", "vowel_changes",
    "distinct_share", "dictionary_share", "common_pairs", "test_path", "credential_near", "placeholder", "placeholder_near",
    "digest_near", "assigned", "quoted", "prefixed", "address", "block", "code_signs", "parts", "extension", "starred",
)


def _any(words: str) -> str:
    """Any of the words as a whole one: ``test`` is not in ``latest``, but in ``test_key`` and ``testKey``."""
    return "(?<![A-Za-z])(?i:" + "|".join(words.split()) + ")(?![a-z])"


def candidates(docs: DataFrame, path: str = "source", keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, finding, start, value, before, after, path (and ``keep``): a row for each candidate."""
    t = F.col("text")
    df = docs.filter(t.rlike(CANDIDATE)).select("doc_id", F.col(path).alias("path"), "text", *keep)
    df = df.withColumns(
        {"_m": F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0)), "_s": F.split(t, CANDIDATE, -1)}
    )
    # start of each match: the lengths of the parts and matches before it, summed along the array
    step = F.transform("_m", lambda m, i: F.char_length(F.get("_s", i)) + F.when(i > 0, F.char_length(F.get("_m", i - 1))).otherwise(0))
    starts = F.aggregate(step, F.array().cast("array<int>"), lambda a, x: F.array_append(a, x + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0))))
    df = df.withColumn("_at", starts)
    df = df.select("doc_id", "path", *keep, "_s", "_at", F.posexplode("_m").alias("finding", "_match"))
    # no other candidate holds a colon before its value
    lead = F.regexp_extract("_match", f"^(?:{_HEAD}|{_ASSIGNED}|{_USER})", 0)
    value = F.substring("_match", F.char_length("_prefix") + 1, F.char_length("_match"))
    return (
        df.withColumn("_prefix", lead)
        .withColumn("value", F.regexp_replace(value, r"[,;)\]}>\s]+$", ""))
        .select(
            "doc_id", "path", *keep, "finding",
            (F.get("_at", "finding") + F.char_length("_prefix")).cast("bigint").alias("start"),
            "value",
            F.concat(F.right(F.get("_s", "finding"), F.lit(CONTEXT)), "_prefix").alias("before"),
            F.left(F.get("_s", F.col("finding") + 1), F.lit(CONTEXT)).alias("after"),
        )
        .filter("value <> ''")
    )


def _share(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)) / F.char_length("value")


def with_features(found: DataFrame) -> DataFrame:
    """The columns ``FEATURES``, all doubles."""
    near = F.concat(F.regexp_extract("before", r"(?:\S+\s+){0,3}\S*$", 0), F.lit(" "), F.regexp_extract("after", r"^\S*(?:\s+\S+){0,2}", 0))
    left = F.char_length("value") - F.char_length(F.regexp_replace("value", "(?i)" + "|".join(DICTIONARY.split()), ""))
    pairs = "(?i)(?=" + "|".join(COMMON_PAIRS.split()) + ")"
    values = {
        "length": F.char_length("value"),
        "digit_share": _share("[0-9]"),
        "upper_share": _share("[A-Z]"),
        "other_share": _share("[^A-Za-z0-9]"),
        "kind_changes": _share("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"),
        "case_changes": _share("[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "vowel_changes": _share("(?i)[aeiou](?=[b-df-hj-np-tv-z])|[b-df-hj-np-tv-z](?=[aeiou])"),
        "distinct_share": F.size(F.array_distinct(F.split("value", ""))) / F.char_length("value"),
        "dictionary_share": left / F.char_length("value"),
        "common_pairs": _share(pairs),
        "test_path": F.coalesce(F.col("path"), F.lit("")).rlike(_any(TEST_PATHS)),
        "credential_near": near.rlike(f"(?i:{_WORDS})"),
        "placeholder": F.col("value").rlike(_any(PLACEHOLDERS)),
        "placeholder_near": near.rlike(_any(PLACEHOLDERS)),
        "digest_near": near.rlike(_any(DIGEST_WORDS)),
        "assigned": F.col("before").rlike(rf"(?i:{_WORDS})[^\s:=]*[ \t]*[:=]+[ \t]*[\"']?$"),
        "quoted": F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']"),
        "prefixed": F.col("value").rlike(f"^{_PREFIX}"),
        "address": F.col("before").rlike(r"://[^\s/]*:$") & F.col("after").rlike("^@"),
        "block": F.col("before").rlike(r"PRIVATE KEY-----[\s\\]*$"),
        "code_signs": _share(r"[(){}\[\]<>$%.,;']"),
        "parts": F.size(F.split("value", r"[-_./]+")),
        "extension": F.col("value").rlike(r"(?i)\.[a-z]{2,5}[0-9]?$"),
        "starred": _share(r"(.)(?=\1\1)"),
    }
    return found.withColumns({k: v.cast("double") for k, v in values.items()})


def labelled_findings(spark: SparkSession) -> DataFrame:
    """The candidates of ``secret_findings`` with their features, ``kind`` and ``label`` (1.0 secret, 0.0 not).

    A candidate is secret if it lies in the secret that its text holds; anything else around is none.
    """
    texts = written(labelled_texts(spark).withColumnRenamed("value", "_value"), "labelled")
    found = candidates(texts, keep=("kind", "_value", "secret"))
    inside = F.col("secret") & F.contains(F.col("_value"), F.col("value"))
    return with_features(found).withColumn("label", inside.cast("double")).drop("_value", "secret")


def _training(labelled: DataFrame, most: int) -> DataFrame:
    """At most ``most`` findings of each label, by hash; in one sorted part, so that reruns agree."""
    key = F.md5(F.concat_ws("|", "value", "before", "after"))
    parts = [
        labelled.filter(F.col("label") == y).select("label", *FEATURES, key.alias("_key")).orderBy("_key", *FEATURES).limit(most)
        for y in (0.0, 1.0)
    ]
    return written(parts[0].union(parts[1]).coalesce(1).sortWithinPartitions("_key", "label", *FEATURES), "findings")


def judged(found: DataFrame, labelled: DataFrame | None = None, most: int = MAX_TRAINING) -> DataFrame:
    """``found`` (written, with features) with ``score`` and ``is_secret``.

    ``labelled`` has the same columns and ``label`` (1.0 secret, 0.0 not).
    """
    if labelled is None:
        labelled = labelled_findings(found.sparkSession)
    train = _training(labelled, most)
    kinds = train.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).first()
    if not all(kinds):
        only = F.lit(1.0 if kinds[1] else 0.0)
        return found.withColumn("score", only).withColumn("is_secret", F.col("score") >= THRESHOLD)
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="label", probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_y",
        numTrees=TREES, maxDepth=DEPTH, seed=SEED,
    )
    model = forest.fit(vector.transform(train))
    out = model.transform(vector.transform(found)).withColumn("score", F.get(vector_to_array("_p"), F.lit(1)))
    return out.withColumn("is_secret", F.col("score") >= THRESHOLD).drop("_features", "_p", "_raw", "_y")


def scan(docs: DataFrame, labelled: DataFrame | None = None, path: str = "source") -> DataFrame:
    """doc_id, finding, start, length, sha256, score, is_secret: every candidate of every text.

    The value itself is not repeated: its SHA-256 and place identify it.
    """
    found = written(with_features(candidates(docs, path)), "candidates")
    return judged(found, labelled).select(
        "doc_id", "finding", "start", F.col("length").cast("bigint").alias("length"),
        F.sha2("value", 256).alias("sha256"), "score", "is_secret",
    )


def redacted(docs: DataFrame, labelled: DataFrame | None = None, path: str = "source") -> DataFrame:
    """``docs`` with every secret replaced by ``MARK``; texts without one stay as they are.

    Only texts with candidates are joined with their findings; the others pass without a shuffle.
    ``n_chars``, where there is one, follows the text.
    """
    key, at, secrets = (free_name(docs.columns, x) for x in ("_id", "_hash", "_secrets"))
    hashed = docs.withColumn(at, F.xxhash64("text"))
    found = written(with_features(candidates(hashed, path, keep=(at,))), "candidates")
    per_text = judged(found, labelled).filter("is_secret").groupBy(F.col("doc_id").alias(key), at).agg(
        F.collect_set("value").alias(secrets)
    )
    # longer ones first: a secret may contain another
    longest = F.transform(
        F.sort_array(F.transform(secrets, lambda v: F.struct(-F.char_length(v), v.alias("v")))), lambda s: s["v"]
    )
    maybe = F.coalesce(F.col("text").rlike(CANDIDATE), F.lit(False))
    other = per_text.withColumnRenamed(at, at + "2")
    hit = hashed.filter(maybe).join(other, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(at) == F.col(at + "2")), "left")
    text = F.when(
        F.col(secrets).isNotNull(), F.aggregate(longest, F.col("text"), lambda t, v: F.replace(t, v, F.lit(MARK)))
    ).otherwise(F.col("text"))
    clean = free_name(docs.columns, "_clean")
    hit = hit.withColumn(clean, text)
    changed = {"text": F.col(clean)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(secrets).isNotNull(), F.char_length(clean).cast("bigint")).otherwise(F.col("n_chars"))
    hit = hit.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
    return documents_like(docs.filter(~maybe), docs).union(hit)
