"""DuckDB counterparts of the queries whose whole result SQL can express."""

from __future__ import annotations

from lendspark.llm.mixing import REPEATS, WEIGHTS
from lendspark.llm.urls import RULES

_SPACES = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"

def _rule_cases(part: str) -> str:
    """The rules, longest first, as branches of a CASE that yields the rule or its verdict."""
    branches = []
    for verdict, rule in sorted(RULES, key=lambda r: -len(r[1])):
        host, slash, path = rule.partition("/")
        value = rule if part == "rule" else verdict
        branches.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{path}') THEN '{value}'")
    return "CASE " + " ".join(branches) + " END"


_OP4 = rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substring(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_replace(regexp_replace(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '(^|&)utm_[^&]*', '', 'g'), '^&', '') AS query
  FROM cut
), keyed AS (
  SELECT *, CASE WHEN regexp_replace(host, '^www\.', '') <> '' THEN regexp_replace(host, '^www\.', '')
    || regexp_replace(path, '/+$', '') || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS key FROM parts
), counted AS (
  SELECT *, key IS NOT NULL AND count(*) OVER (PARTITION BY key) > 1 AS listed FROM keyed
)
SELECT page_id, host, path, {_rule_cases("rule")} AS rule,
  coalesce({_rule_cases("verdict")}, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM counted
"""

_OP6 = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    list_extract([{", ".join(map(str, WEIGHTS))}], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1 AS INT)) AS weight
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, {REPEATS} * source_size AS cap, row_number() OVER (ORDER BY {REPEATS} * source_size / weight, source NULLS LAST) AS k FROM sources
), levels AS (
  SELECT k, cap, weight,
    sum(source_size) OVER () - (sum(cap) OVER (ORDER BY k) - cap) AS room,
    sum(weight) OVER () - (sum(weight) OVER (ORDER BY k) - weight) AS shares
  FROM ordered
), cut AS (
  SELECT k, CAST(room AS BIGINT) AS room, CAST(shares AS BIGINT) AS shares FROM levels
  WHERE CAST(CAST(room AS BIGINT) * weight AS DOUBLE) / CAST(shares AS DOUBLE) <= cap ORDER BY k LIMIT 1
), goals AS (
  SELECT source, source_size,
    CASE WHEN o.k < c.k THEN CAST(cap AS DOUBLE) ELSE CAST(room * weight AS DOUBLE) / CAST(shares AS DOUBLE) END AS target
  FROM ordered o, cut c
), placed AS (
  SELECT s.*, g.source_size, g.target,
    coalesce(sum(s.size) OVER (PARTITION BY s.source
      ORDER BY md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(size AS VARCHAR)), doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0 ELSE
  floor(round(target) / source_size) * size
  + greatest(0, least(size, round(target) - start - floor(round(target) / source_size) * source_size)) END AS BIGINT) AS taken
FROM placed
"""

_OP7 = rf"""
WITH hashed AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, row_number() OVER () AS arrival,
    sha256(regexp_replace(coalesce(text, ''), '{_SPACES}', '', 'g')) AS text_sha256 FROM documents
), ranked AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id FROM hashed
  WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST, arrival)
)
SELECT doc_id, keep_id, CAST(count(*) OVER (PARTITION BY text_sha256) AS BIGINT) AS group_size, place = 1 AS kept, text_sha256 FROM ranked
"""

_OP10 = """
WITH RECURSIVE rows AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), good AS (
  SELECT * FROM rows WHERE v IS NOT NULL AND len(v) > 0 AND list_aggregate(v, 'count') = len(v)
    AND isfinite(list_aggregate(v, 'max')) AND isfinite(list_aggregate(v, 'min'))
    AND (list_aggregate(v, 'max') <> 0 OR list_aggregate(v, 'min') <> 0)
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM rows UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), lowest AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), counted AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT rows.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, rows.vec_id = component_id AS kept
FROM rows JOIN lowest USING (vec_id) LEFT JOIN counted USING (vec_id)
"""

# The CRC of every byte value, and the CRC-32 of a text's UTF-8 bytes beside that table.
_CRC_TABLE = (
    "(SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: "
    "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS tab)"
)
_CASE = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _crc(text: str) -> str:
    byte = f"CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT)"
    bytes_ = f"list_transform(range(octet_length(encode({text}))), lambda i: {byte})"
    return f"xor(list_reduce({bytes_}, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


_OP11 = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), {_CASE}) AS run
  FROM documents
), counted AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS keyed, run, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, n, {_crc('keyed')} AS h FROM counted, {_CRC_TABLE}
), thinned AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM thinned WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), shorter AS MATERIALIZED (
  SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), holed AS (
  SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS hole FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM holed a JOIN holed b ON a.hole = b.hole AND a.word <> b.word
  UNION ALL SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.less = w.word
  UNION ALL SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.less = w.word
), best AS (
  SELECT word, CAST(count(*) AS BIGINT) AS n_near, max(n) AS most, arg_min(other, (-n, other)) AS other FROM near GROUP BY word
), tied AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * n THEN other END AS form, CASE WHEN most >= 2 * n THEN most END AS form_n
  FROM words LEFT JOIN best USING (word)
), climbed AS (
  SELECT word, word AS at, form FROM tied UNION ALL SELECT c.word, t.word, t.form FROM climbed c JOIN tied t ON c.form = t.word
)
SELECT tied.word, tied.form, climbed.at AS root, n, n_near, form_n FROM tied JOIN climbed ON climbed.word = tied.word AND climbed.form IS NULL
"""

_OP12 = rf"""
WITH words AS (
  SELECT 's' AS side, doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), {_CASE}), '{_ALNUM}') AS w FROM documents
  UNION ALL
  SELECT 't', NULL, row_number() OVER (),
    regexp_extract_all(translate(coalesce(text, ''), {_CASE}), '{_ALNUM}') FROM benchmark
), runs AS MATERIALIZED (
  SELECT side, r, array_to_string(w[i : i + k - 1], ' ') AS feature FROM (
    SELECT side, r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest([1, 2, 3]) AS k))
), hashed AS MATERIALIZED (
  SELECT feature, {_crc('feature')} % 10000 AS bucket FROM (SELECT DISTINCT feature FROM runs), {_CRC_TABLE}
), counts AS (
  SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM runs JOIN hashed USING (feature) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + 10000) / ((s + 1.0::DOUBLE) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain FROM counts
), weights AS (
  SELECT r, CAST(count(*) AS BIGINT) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM runs JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE side = 's' GROUP BY r
), scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (r) WHERE side = 's'
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) FILTER (n_words >= 20) OVER () AS fit FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * fit // 100 THEN place END AS rank FROM ranked
"""

ORACLES: dict[str, str] = {
    "op4_url_filter": _OP4, "op6_source_mixing": _OP6, "op7_exact_dedup": _OP7, "op10_embedding_near_dedup": _OP10,
    "op11_spelling_variants": _OP11, "op12_importance_resampling": _OP12,
}
