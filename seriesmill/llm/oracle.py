"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from seriesmill.llm.decontamination import PERCENT, TOKEN, WIDTH
from seriesmill.llm.mixing import MOST_EPOCHS, SEED, SHARE_PERCENT, WEIGHTS
from seriesmill.llm.url_filter import LISTED_WORDS, RULES
from seriesmill.llm.words import WORD

DECONTAMINATION = f"""
WITH item AS (
  SELECT item_id, w, least({WIDTH}, len(w)) AS width FROM (SELECT item_id, regexp_extract_all(lower(text), '{TOKEN}') AS w FROM benchmark)
  WHERE len(w) > 0
), item_shingle AS (
  SELECT DISTINCT item_id, width, array_to_string(w[i:i + width - 1], ' ') AS s
  FROM item, LATERAL (SELECT unnest(range(1, len(w) - width + 2)) AS i)
), doc AS (
  SELECT doc_id, regexp_extract_all(lower(text), '{TOKEN}') AS w, width FROM documents, (SELECT DISTINCT width FROM item)
), doc_shingle AS (
  SELECT DISTINCT doc_id, width, array_to_string(w[i:i + width - 1], ' ') AS s
  FROM doc, LATERAL (SELECT unnest(range(1, len(w) - width + 2)) AS i)
), size AS (
  SELECT item_id, count(*) AS size FROM item_shingle GROUP BY ALL
)
SELECT doc_id, item_id, count(*) AS shared, any_value(size) AS size
FROM doc_shingle JOIN item_shingle USING (width, s) JOIN size USING (item_id)
GROUP BY doc_id, item_id HAVING 100 * count(*) >= {PERCENT} * any_value(size)
"""


def _rule_case(column: str) -> str:
    """The longest rule first, each as one branch."""
    branches = [
        f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') "
        f"THEN '{host + path if column == 'rule' else verdict}'"
        for verdict, host, path in sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    ]
    return f"CASE {' '.join(branches)} END"


_HOST = f"""translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""

URLS = f"""
WITH part AS (
  SELECT page_id, {_HOST} AS host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages
), judged AS (
  SELECT *, {_rule_case('rule')} AS rule, {_rule_case('verdict')} AS by_rule,
    len(list_intersect(string_split_regex(host, '[.-]'), [{', '.join(f"'{w}'" for w in LISTED_WORDS)}])) > 0 AS listed
  FROM part
)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM judged
"""

# 40 hexadecimal digits are eight numbers of 20 bits, and each of them four letters.
_BASE32 = """array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)
    for i in range(32)], '')"""

ARCHIVES = f"""
WITH page AS (
  SELECT page_id, url, encode(coalesce(html, '')) AS payload, make_timestamp((1704067200 + page_id % 1000000000) * 1000000) AS seen FROM pages
), hashed AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex, strftime(seen, '%Y-%m-%dT%H:%M:%SZ') AS captured_at,
    lower(url) AS url, regexp_extract(lower(url), '://([^/?#]*)', 1) AS host
  FROM page
), keyed AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first,
    array_to_string(list_reverse(string_split(regexp_replace(host, '^www[.]', ''), '.')), ',') || ')'
      || coalesce(nullif(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), ''), '/')
      || coalesce('?' || nullif(regexp_extract(url, '[?]([^#]*)', 1), ''), '') AS url_key
  FROM hashed
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, url_key, captured_at,
  row_number() OVER (ORDER BY url_key, captured_at, page_id) - 1 AS position
FROM keyed
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM word, LATERAL (SELECT unnest(range(1, greatest(len(w), 2))) AS i) WHERE len(w) > 0
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_common
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * n_common >= 80 * (x.n + y.n - n_common)
), way AS (
  SELECT a, b FROM link UNION SELECT b, a FROM link
), reach AS (
  SELECT a, b FROM way UNION SELECT reach.a, way.b FROM reach JOIN way ON reach.b = way.a
), least AS (
  SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
  doc_id <= coalesce(low, doc_id) AS kept
FROM documents LEFT JOIN size USING (doc_id) LEFT JOIN least USING (doc_id)
"""

MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    ('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, [{', '.join(map(str, WEIGHTS))}][place % {len(WEIGHTS)} + 1]::DOUBLE AS weight, source_size::DOUBLE * {MOST_EPOCHS} AS most
  FROM per_source
), trial AS (
  SELECT k.place, k.most / k.weight AS ratio,
    (any_value(total) * {SHARE_PERCENT} / 100 - coalesce(sum(o.most) FILTER (o.most / o.weight < k.most / k.weight), 0))
      / sum(o.weight) FILTER (o.most / o.weight >= k.most / k.weight) AS level
  FROM weighted k, weighted o, (SELECT sum(source_size)::DOUBLE AS total FROM weighted) GROUP BY k.place, k.most, k.weight
), chosen AS (
  SELECT min_by(level, ratio) AS level FROM trial WHERE ratio > level
), target AS (
  SELECT source, source_size, least(most, coalesce(level * weight, most)) AS target FROM weighted, chosen
), placed AS (
  SELECT sized.doc_id, sized.source, size, source_size, target,
    coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs
  FROM sized JOIN target ON sized.source IS NOT DISTINCT FROM target.source
)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken, source
FROM placed
"""

AUDIT = f"""
WITH word AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w
  FROM documents
), judged AS (
  SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
    (len(w) < 200)::INTEGER + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INTEGER
      + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INTEGER
      + 8 * regexp_matches(text, '[#$%&*|]')::INTEGER
      + 16 * (doc_id > min(doc_id) OVER (PARTITION BY text))::INTEGER AS failed
  FROM word LEFT JOIN labels USING (doc_id)
), left_over AS (
  SELECT part, s, count(*) FILTER (failed & s = 0) AS n, count(*) FILTER (failed & s = 0 AND good) AS n_good,
    count(*) FILTER (failed & s = 0 AND toxic) AS n_toxic
  FROM judged, range(32) AS subsets(s) GROUP BY part, s
), filter_orders AS (
  SELECT a || b || c || d || e AS filter_order
  FROM (SELECT unnest(string_split('ABCDE', '')) AS a), (SELECT unnest(string_split('ABCDE', '')) AS b),
    (SELECT unnest(string_split('ABCDE', '')) AS c), (SELECT unnest(string_split('ABCDE', '')) AS d),
    (SELECT unnest(string_split('ABCDE', '')) AS e)
  WHERE len(list_distinct([a, b, c, d, e])) = 5
), steps AS (
  SELECT filter_order, step, (1 << (instr('ABCDE', substr(filter_order, step, 1)) - 1))::BIGINT AS bit,
    list_sum([1 << (instr('ABCDE', substr(filter_order, i, 1)) - 1) for i in range(1, step + 1)])::BIGINT AS after
  FROM filter_orders, LATERAL (SELECT unnest(range(1, 6))::INTEGER AS step)
), figures AS (
  SELECT y.part, filter_order, step, bit, y.n AS kept, x.n - y.n AS removed,
    every.n - one.n - (x.n - y.n) AS redundant, others.n - none.n AS unique_fails,
    x.n_good - y.n_good AS good_lost, x.n_toxic - y.n_toxic AS toxic_lost
  FROM steps JOIN left_over y ON y.s = after JOIN left_over x ON x.s = after - bit AND x.part = y.part
    JOIN left_over every ON every.s = 0 AND every.part = y.part JOIN left_over one ON one.s = bit AND one.part = y.part
    JOIN left_over others ON others.s = 31 - bit AND others.part = y.part JOIN left_over none ON none.s = 31 AND none.part = y.part
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM figures
"""


def _whole_vectors(scale: int, label: str = "") -> str:
    """Rows of `embeddings` that take part, components as whole numbers."""
    return f"""SELECT vec_id, {label} [floor({scale} * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


HARD_NEGATIVES = f"""
WITH vec AS (
  {_whole_vectors(256, "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,")} AND label IS NOT NULL
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM vec a JOIN vec b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

TOP_SCORES = f"""
WITH vec AS (
  {_whole_vectors(64)}
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM vec q JOIN vec c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": DECONTAMINATION,
        "op3_url_filter": URLS,
        "op4_warc_index": ARCHIVES,
        "op8_minhash_dedup": NEAR_DUPLICATES,
        "op9_source_mixing": MIXING,
        "op11_filter_audit": AUDIT,
        "op12_hard_negatives": HARD_NEGATIVES,
        "op13_top_scores": TOP_SCORES,
    }
