"""DuckDB SQL for the queries that SQL can express."""

from strata.llm.quality import LANGUAGES, RULES, STOP_WORDS

_STOPS = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS.split())))
_LANGUAGES = ", ".join(f"'{x}'" for x in LANGUAGES)
_BROKEN = ", ".join(
    "CASE WHEN "
    + " OR ".join([f"{r.metric} < {r.low}"] * (r.low is not None) + [f"{r.metric} > {r.high}"] * (r.high is not None))
    + f" THEN '{r.name}' END"
    for r in RULES
)

OP5 = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lower(split_part(lang, '-', 1)) IN ({_LANGUAGES}), true) AS known
  FROM documents
), split AS (
  SELECT doc_id, text, known, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM t
), win AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM win) WHERE n > 1
), cov AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), base AS (
  SELECT s.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
         known, len(list_filter(words, lambda x: x IN ({_STOPS}))) AS n_stop_words,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullet,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis
  FROM split s LEFT JOIN cov c ON s.doc_id = c.doc_id
), metrics AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words::DOUBLE ELSE 0 END AS mean_word_chars,
         CASE WHEN n_words > 0 THEN n_symbols::DOUBLE / n_words::DOUBLE ELSE 0 END AS symbols_per_word,
         CASE WHEN NOT known THEN NULL WHEN n_words > 0 THEN n_stop_words::DOUBLE / n_words::DOUBLE ELSE 0 END AS stop_word_share,
         CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines::DOUBLE ELSE 0 END AS dup_line_share,
         CASE WHEN n_lines > 0 THEN n_bullet::DOUBLE / n_lines::DOUBLE ELSE 0 END AS bullet_line_share,
         CASE WHEN n_lines > 0 THEN n_ellipsis::DOUBLE / n_lines::DOUBLE ELSE 0 END AS ellipsis_line_share
  FROM base
), judged AS (
  SELECT *, concat_ws(',', {_BROKEN}) AS failed_rules FROM metrics
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM judged
"""

OP8 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, hash(array_to_string(words[i:i + 4], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both
  FROM sh x JOIN sh y ON x.h = y.h AND x.doc_id <> y.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM w
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), c AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w JOIN c ON w.doc_id = c.doc_id LEFT JOIN n ON w.doc_id = n.doc_id
"""

OP9 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source
), fill AS (
  SELECT 0 AS step, (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE / sum(weight)::DOUBLE FROM s) AS level, -1::BIGINT AS capped
  UNION ALL
  SELECT f.step + 1,
         (1.5::DOUBLE * a.total - coalesce(a.words, 0))::DOUBLE / a.rest::DOUBLE, a.n
  FROM fill f, LATERAL (
    SELECT count(*) FILTER (source_size * 2 <= f.level * weight) AS n,
           sum(source_size * 2) FILTER (source_size * 2 <= f.level * weight)::DOUBLE AS words,
           sum(weight) FILTER (source_size * 2 > f.level * weight) AS rest, sum(source_size)::DOUBLE AS total
    FROM s) a
  WHERE a.n <> f.capped AND a.rest > 0
), t AS (
  SELECT source, source_size, least(source_size::DOUBLE * 2, weight * (SELECT arg_max(level, step) FROM fill)) AS target
  FROM s
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE
         (budget // source_size) * size + greatest(0, least(size, budget % source_size - start)) END)::BIGINT AS taken
FROM p
"""

# A checksum of the decimal doc_id: CRC-32 bit by bit, -1 standing for one shift.
_CRC = (
    "xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
    "lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])), "
    "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"
)


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


OP12 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS key, {_leaf("n_chars")} AS leaf,
         CASE WHEN {_CRC} % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS tampered
  FROM documents
), p AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY key) AS n
  FROM d
), lv AS (
  SELECT key, 0 AS level, pos, n, leaf AS h FROM p
  UNION ALL
  SELECT key, level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM lv WHERE n > 1 GROUP BY key, level, pos // 2
), s AS (
  SELECT key, h AS subroot, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n FROM lv WHERE n = 1
), tv AS (
  SELECT 0 AS level, pos, n, subroot AS h FROM s
  UNION ALL
  SELECT level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM tv WHERE n > 1 GROUP BY level, pos // 2
), low AS (
  SELECT p.key, p.pos AS id, 0 AS level, p.pos, p.n, p.tampered AS folded, '' AS proof FROM p
  UNION ALL
  SELECT c.key, c.id, c.level + 1, c.pos // 2, (c.n + 1) // 2,
         sha256(CASE WHEN c.pos % 2 = 1 THEN coalesce(o.h, '') || c.folded ELSE c.folded || coalesce(o.h, '') END),
         c.proof || coalesce(o.h, '')
  FROM low c LEFT JOIN lv o ON o.key = c.key AND o.level = c.level AND o.pos = xor(c.pos, 1)
  WHERE c.n > 1
), high AS (
  SELECT c.key, c.id, 0 AS level, s.pos, s.n, c.folded, c.proof FROM low c JOIN s ON s.key = c.key WHERE c.n = 1
  UNION ALL
  SELECT c.key, c.id, c.level + 1, c.pos // 2, (c.n + 1) // 2,
         sha256(CASE WHEN c.pos % 2 = 1 THEN coalesce(o.h, '') || c.folded ELSE c.folded || coalesce(o.h, '') END),
         c.proof || coalesce(o.h, '')
  FROM high c LEFT JOIN tv o ON o.level = c.level AND o.pos = xor(c.pos, 1)
  WHERE c.n > 1
)
SELECT p.doc_id, p.leaf, s.subroot, r.h AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root,
       c.folded = r.h AS verified
FROM p JOIN s ON s.key = p.key JOIN high c ON c.key = p.key AND c.id = p.pos AND c.n = 1 JOIN tv r ON r.n = 1
"""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP13 = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS id, {_WORDS} AS w FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark
), win AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT id, i, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win))
), hits AS (
  SELECT dw.id, dw.i, dw.k, win.item FROM dw JOIN win ON dw.k = win.k AND dw.win = win.win
), n AS (
  SELECT id, count(DISTINCT place) AS n_hit FROM (SELECT id, unnest(range(i, i + k)) AS place FROM hits) GROUP BY id
), items AS (
  SELECT id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n.n_hit, 0)::BIGINT AS n_hit,
       coalesce(items.n_items, 0)::BIGINT AS n_items, sha256(coalesce(items.items, '')) AS items_sha256,
       coalesce(n.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON n.id = d.id LEFT JOIN items ON items.id = d.id
"""

ORACLE: dict[str, str] = {
    "op5_quality_rules": OP5,
    "op8_minhash_near_dedup": OP8,
    "op9_mixing": OP9,
    "op12_merkle_manifest": OP12,
    "op13_decontamination": OP13,
}
