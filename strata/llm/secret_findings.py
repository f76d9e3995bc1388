"""Labelled findings with known truth, made by Spark expressions: the training set of the secret scan.

Each row is a short text in which one value of a known kind stands between ordinary words. Kinds of
secrets are opaque keys, prefixed keys, pass phrases with and without digits, credentials in addresses and key
blocks; decoys are placeholders, digests, numbers, names, file paths, references in code and plain words.
Values, words and lead-ins are drawn by hashes of the row's number, so reruns and all clusters agree. ``PER_KIND``
rows of each kind bound the set; it doesn't depend on the documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PER_KIND = 250
ROW = "id"

# Words that pass phrases, names and paths are made of, and the text around.
WORDS = (
    "correct horse battery staple orange garden window silver market planet river stone winter summer dragon monkey "
    "purple coffee sunshine castle football thunder rocket shadow ginger pepper copper hunter marble forest"
).split()
AROUND = (
    "the latest version of this page was not changed nonetheless it is here for users who set up the server and want to "
    "connect from their own machine please see the notes below before you start a new one greatest contest protest "
    "attested yourself hashed committed rebuilt"
).split()


def _draw(salt: str) -> Column:
    """A hash of the row and the salt."""
    return F.sha2(F.concat_ws(":", F.lit(salt), F.col(ROW).cast("string")), 256)


def _number(salt: str, most: int) -> Column:
    return F.conv(F.substring(_draw(salt), 1, 8), 16, 10).cast("bigint") % most


def _one(salt: str, items: list[str]) -> Column:
    return F.get(F.array(*[F.lit(i) for i in items]), _number(salt, len(items)).cast("int"))


def _hex(salt: str, n: int) -> Column:
    return F.substring(F.concat(_draw(salt), _draw(salt + "+")), 1, n)


def _mixed(salt: str, n: int) -> Column:
    """Letters of both cases and digits."""
    raw = F.concat(*[F.base64(F.unhex(_draw(f"{salt}{k}"))) for k in range(4)])
    return F.substring(F.translate(raw, "+/=", ""), 1, n)


def _digits(salt: str, n: int) -> Column:
    return F.substring(F.translate(F.concat(_draw(salt), _draw(salt + "+")), "abcdef", "271839"), 1, n)


def _phrase(salt: str, n: int, between: str = "", capital: bool = True) -> Column:
    words = [_one(f"{salt}{k}", WORDS) for k in range(n)]
    return F.concat_ws(between, *[F.initcap(w) if capital else w for w in words])


def _around(salt: str, n: int) -> Column:
    return F.concat_ws(" ", *[_one(f"{salt}{k}", AROUND) for k in range(n)])


ASSIGN = ["password = \"", "token = \"", "api_key: \"", "secret='", "PASSWORD=", "access_key = ", "pwd: ", "auth_token=", "db_password: ", "\"apiKey\": \""]
BARE = ["use ", "is ", "see ", "value ", "with ", "(", "got "]
PLACE = [
    "changeme", "your_password_here", "<your-token-here>", "xxxxxxxxxxxx", "example_token", "dummy-secret-1234",
    "placeholder", "REPLACE_ME_123", "test_password_1", "insert-your-key", "********", "todo-fill-in", "YOUR_API_KEY",
    "fake_secret_000000", "sample1234567890abcd", "redacted", "[redacted]", "none-given",
]
CODE = [
    "os.environ['TOKEN']", "getPassword()", "config.secret_key", "request.headers.get", "${SECRET_TOKEN}", "process.env.API_KEY",
    "self._password", "$DB_PASSWORD", "{{secret_name}}", "settings.AUTH_TOKEN,", "input('Password')", "null;", "String", "str,", "%(password)s",
]
PLAIN = ["required", "minimum", "optional", "forgotten", "expires", "however", "between", "invalid", "missing", "created", "policies", "management"]
DIGEST = ["sha256: ", "commit ", "md5 = ", "checksum: ", "digest sha1 ", "build id ", "revision ", "etag: ", "hash: "]
KEY_HEAD = ["-----BEGIN PRIVATE KEY-----", "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN OPENSSH PRIVATE KEY-----"]


def _quoted(lead: Column, value: Column) -> Column:
    """A lead-in that ends in a quote gets the same one behind the value."""
    end = F.right(lead, F.lit(1))
    return F.concat(lead, value, F.when(end.isin('"', "'"), end).otherwise(""))


def kinds() -> dict[str, tuple[Column, Column, bool]]:
    """Kind → the finding as it stands in the text, its value, and whether it is a secret."""
    assign, bare = _one("assign", ASSIGN), _one("bare", BARE)
    leet = F.translate(_phrase("leet", 1), "aeos", "4305")
    values = {
        "assigned hex": (assign, F.when(_number("n", 2) == 0, _hex("hex", 32)).otherwise(_hex("hex", 40)), True),
        "assigned key": (assign, F.when(_number("n", 2) == 0, _mixed("key", 24)).otherwise(_mixed("key", 44)), True),
        "short hex": (assign, F.substr(_hex("short", 20), F.lit(1), (8 + _number("size", 13)).cast("int")), True),
        "short key": (assign, F.substr(_mixed("small", 20), F.lit(1), (8 + _number("size", 13)).cast("int")), True),
        "pin": (assign, F.substr(_digits("pin", 20), F.lit(1), (8 + _number("size", 11)).cast("int")), True),
        "two words and digit": (assign, F.concat(_one("two1", WORDS), _digits("t", 1), _one("two2", WORDS), _digits("s", 1)), True),
        "pass phrase": (assign, _phrase("phrase", 3), True),
        "pass word with digits": (assign, F.concat(leet, _one("sign", ["&", "!", "#", "_", "$"]), _digits("d", 2)), True),
        "pass word and year": (assign, F.concat(_phrase("year", 1), _digits("y", 4), _one("sign", ["!", "", "?"])), True),
        "prefixed key": (
            F.when(_number("n", 3) == 0, assign).otherwise(bare),
            F.concat(_one("prefix", ["ghp_", "gho_", "sk_live_", "xoxb-", "glpat-"]), _mixed("prefixed", 36)), True,
        ),
        "access key id": (F.when(_number("n", 3) == 0, assign).otherwise(bare), F.concat(F.lit("AKIA"), F.upper(_mixed("akia", 16))), True),
        "address": (
            F.concat(_one("scheme", ["postgres", "mysql", "https", "amqp", "mongodb", "ftp"]), F.lit("://"), _one("user", ["admin", "root", "app", "svc_user"]), F.lit(":")),
            F.when(_number("n", 3) == 0, F.substr(_mixed("url", 20), F.lit(1), (8 + _number("size", 13)).cast("int")))
            .when(_number("n", 3) == 1, F.concat(leet, _digits("u", 3))).otherwise(F.concat(F.lower(leet), F.lit("pw"))), True,
        ),
        "key block": (F.concat(_one("head", KEY_HEAD), F.lit("\n")), F.concat(*[F.concat(_mixed(f"block{k}", 64), F.lit("\n")) for k in range(3)], _mixed("last", 20), F.lit("==\n")), True),
        "placeholder": (assign, _one("place", PLACE), False),
        "reference": (assign, _one("code", CODE), False),
        "plain word": (_one("colon", ["password: ", "the secret: ", "token: ", "pwd: ", "credential: "]), _one("plain", PLAIN), False),
        "digest": (_one("digest", DIGEST), F.when(_number("n", 3) == 0, _hex("dig", 32)).when(_number("n", 3) == 1, _hex("dig", 40)).otherwise(_hex("dig", 64)), False),
        "uuid": (bare, F.regexp_replace(_hex("uuid", 32), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), False),
        "number": (bare, F.when(_number("n", 2) == 0, _digits("num", 16)).otherwise(F.concat(_digits("v", 2), F.lit("."), _digits("w", 2), F.lit(".2024-03-"), _digits("x", 6))), False),
        "host": (bare, F.concat(_phrase("host", 2, "-", False), _digits("h", 1), F.lit(".example.com")), False),
        "path": (bare, F.concat(_phrase("dir", 2, "/", False), F.lit("/"), _phrase("file", 1, "", False), _digits("f", 2), F.lit(".html")), False),
        "name": (bare, F.concat(_phrase("name", 3, "_", False), F.lit("_"), _digits("m", 1)), False),
        "camel name": (bare, F.concat(_phrase("camel", 3), _digits("c", 2)), False),
        "long words": (bare, F.concat(_phrase("long", 3, "-", False), F.lit("-"), _digits("l", 4)), False),
    }
    return {k: (_quoted(lead, value), value, secret) for k, (lead, value, secret) in values.items()}


def labelled_texts(spark: SparkSession, per_kind: int = PER_KIND) -> DataFrame:
    """doc_id, kind, text, source, value and secret of every row."""
    parts = []
    for k, (kind, (finding, value, secret)) in enumerate(kinds().items()):
        behind = {
            "address": F.concat(F.lit("@db"), _digits("at", 1), F.lit(".internal/main")),
            "key block": F.regexp_replace(_one("tail", KEY_HEAD), "BEGIN", "END"),
        }.get(kind, F.lit(""))
        text = F.concat(_around("before", 7), F.lit(" "), finding, behind, F.lit(" "), _around("after", 7))
        parts.append(
            spark.range(k * per_kind, (k + 1) * per_kind, numPartitions=1).select(
                F.col(ROW).alias("doc_id"), F.lit(kind).alias("kind"), text.alias("text"),
                F.lit(None).cast("string").alias("source"), value.alias("value"), F.lit(secret).alias("secret"),
            )
        )
    return reduce(DataFrame.union, parts)
