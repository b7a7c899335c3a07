"""Checking SQL of the corpus queries; every statement sees whole tables."""

from __future__ import annotations

from linespan.llm import line_dedup, near_dedup, quality_rules, url_filter

WS = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _rules() -> str:
    return ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in url_filter.RULES)


def _worth(level: str, mean: str) -> str:
    """Worth of a level's prior, as a scalar query."""
    variance = f"{mean} * (1 - {mean})"
    spread = (
        f"coalesce(sum((bad - labelled * {mean}) ** 2 - labelled * {variance}) / "
        f"nullif(sum(labelled * (labelled - 1) * {variance}), 0), {url_filter.LEAST_SPREAD})"
    )
    bounded = f"greatest({url_filter.LEAST_SPREAD}, least({url_filter.MOST_SPREAD}, {spread}))"
    return f"(SELECT (1 - {bounded}) / {bounded} FROM {level})"


OP2 = f"""
WITH parts AS (
  SELECT page_id, url,
         {LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(verdict, host, path) AS (VALUES {_rules()}),
fits AS (
  SELECT p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
         arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM parts p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.page_id),
outcomes AS (
  SELECT p.page_id, max(CASE WHEN l.quality = 0 OR l.toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM (SELECT page_id, try_cast(regexp_extract(regexp_replace(url, '[?#].*$', ''),
                                                '/([0-9]+)[^/]*/?$', 1) AS BIGINT) AS number FROM pages) p
  JOIN labels l ON l.doc_id = p.number WHERE coalesce(l.quality, l.toxic) IS NOT NULL
  GROUP BY p.page_id),
named AS (
  SELECT host, count(o.bad) AS labelled, coalesce(sum(o.bad), 0) AS bad, string_split(host, '.') AS names,
         CASE WHEN len(names) <= 2 THEN host
              WHEN length(names[-1]) = 2
                   AND names[-2] IN ({", ".join(repr(x) for x in url_filter.SECOND_LEVEL)})
                THEN array_to_string(names[-3:], '.')
              ELSE array_to_string(names[-2:], '.') END AS domain
  FROM parts LEFT JOIN outcomes o USING (page_id) GROUP BY host),
domains AS (
  SELECT domain, regexp_replace(domain, '^[^.]*\\.', '') AS suffix, sum(labelled) AS labelled, sum(bad) AS bad
  FROM named GROUP BY domain),
suffixes AS (
  SELECT suffix, sum(labelled) AS labelled, sum(bad) AS bad,
         (SELECT (sum(bad) + 1.0::DOUBLE) / (sum(labelled) + 2.0::DOUBLE) FROM domains) AS m
  FROM domains GROUP BY suffix),
domain_prior AS (
  SELECT d.*, (s.bad - d.bad + w * s.m) / (s.labelled - d.labelled + w) AS m
  FROM domains d JOIN suffixes s USING (suffix), (SELECT {_worth("suffixes", "m")} AS w)),
host_prior AS (
  SELECT n.*, (d.bad - n.bad + w * d.m) / (d.labelled - n.labelled + w) AS m
  FROM named n JOIN domain_prior d USING (domain), (SELECT {_worth("domain_prior", "m")} AS w)),
reputation AS (
  SELECT host, (bad + w * m) / (labelled + w) AS share,
         share - {url_filter.BOUND_Z} * sqrt(share * (1 - share) / (labelled + w + 1)) AS bound
  FROM host_prior, (SELECT {_worth("host_prior", "m")} AS w))
SELECT p.page_id, p.host, p.path, f.rule,
       coalesce(f.verdict, CASE WHEN r.bound > {url_filter.BLOCK_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN fits f USING (page_id) JOIN reputation r ON r.host = p.host
"""

OP3 = f"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '{WS}', '', 'g') AS content,
         length(coalesce(text, '')) AS points
  FROM documents),
ranked AS (
  SELECT doc_id, content,
         first_value(doc_id) OVER same AS keep_id, row_number() OVER same AS place,
         count(*) OVER (PARTITION BY content) AS group_size
  FROM texts WINDOW same AS (PARTITION BY content ORDER BY points DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(content) AS text_sha256 FROM ranked
"""

OP4 = f"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
held AS (
  SELECT k, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line FROM docs),
keyed AS (SELECT *, {LOWER.format(f"trim(line, {BLANKS})")} AS key FROM held),
frequent AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT k) >= {line_dedup.MIN_DOCUMENTS}),
kept AS (
  SELECT k, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS text
  FROM keyed ANTI JOIN frequent USING (key) GROUP BY k)
SELECT doc_id, len(lines)::BIGINT AS n_lines, len(lines) - coalesce(n, 0) AS n_dropped,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (k)
"""

OP5 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS (
  SELECT k, doc_id, i, array_to_string(w[i : i + 19], ' ') AS win
  FROM (SELECT k, doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs WHERE len(w) >= 20)),
later AS (
  SELECT k, i FROM (SELECT k, i, rank() OVER (PARTITION BY win ORDER BY doc_id NULLS LAST, i) AS r FROM windows)
  WHERE r > 1),
gone AS (SELECT DISTINCT k, i + j AS i FROM later, range(20) t(j)),
words AS (SELECT k, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs),
kept AS (
  SELECT k, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (k, i) GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (k)
"""

OP6 = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
-- The text is compared as a whole set: one row per different set.
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
linked AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * shared.n >= {near_dedup.PERCENT} * (a.n + b.n - shared.n)),
edges AS (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON e.x = r.other)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id,
       d.doc_id = min(r.other) AS kept
FROM docs d LEFT JOIN sizes s USING (doc_id) JOIN reach r USING (doc_id) GROUP BY d.doc_id
"""

OP9 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce('h' || source, 'none') AS host, coalesce(text, '') AS text
  FROM documents),
words AS (
  SELECT k, regexp_extract_all(text, '{WORD}') AS w,
         list_filter(string_split(text, chr(10)), lambda x: length(trim(x, {BLANKS})) > 0) AS lines FROM docs),
windows AS (
  SELECT k, i, array_to_string(w[i : i + 4], ' ') AS win
  FROM (SELECT k, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)),
starts AS (
  SELECT k, i, lead(i) OVER (PARTITION BY k ORDER BY i) AS following
  FROM (SELECT k, i, count(*) OVER (PARTITION BY k, win) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT k, sum(least(5, coalesce(following - i, 5))) AS n FROM starts GROUP BY k),
held AS (
  SELECT d.host, d.k, d.text, lower(trim(x.line, {BLANKS})) AS line, len(regexp_extract_all(x.line, '{WORD}')) AS n
  FROM (SELECT k, unnest(lines) AS line FROM words) x JOIN docs d USING (k)),
texts AS (SELECT host, count(DISTINCT text) AS n FROM docs GROUP BY host),
frequent AS (
  SELECT h.host, h.line FROM held h JOIN texts t USING (host) GROUP BY h.host, h.line, t.n
  HAVING count(DISTINCT h.text) >= {quality_rules.MIN_DOCUMENTS}
     AND count(DISTINCT h.text) * 100 > t.n * {quality_rules.LINE_SHARE}),
lost AS (SELECT k, sum(n) AS n FROM held JOIN frequent USING (host, line) GROUP BY k),
counts AS (
  SELECT d.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(text) - length(regexp_replace(text, '{quality_rules.SYMBOL_CLASS}', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(l.n, 0)::BIGINT AS words_lost
  FROM docs d JOIN words USING (k) LEFT JOIN repeats r USING (k) LEFT JOIN lost l USING (k))
SELECT *, n_words < {quality_rules.MIN_WORDS} OR n_repeat_words * 100 > n_words * {quality_rules.REPEAT_SHARE}
            AS base_failed,
       NOT base_failed AND words_lost * 100 <= n_words * {quality_rules.LOST_SHARE} AS kept
FROM counts
"""

# Weights 5, 2, 1, budget 150 %, at most 2 times, blocks of 16 words, shards of 4,096 filled documents. A source
# has one group of shards up to 16 million documents, so its blocks are allocated to its shards directly.
OP10 = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce('s' || source, 'none') AS source_key,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS draw
  FROM documents),
ranked AS (
  SELECT source_key, sum(size)::BIGINT AS source_size,
         greatest(1, ceil(count(*) FILTER (size > 0) / 4096))::BIGINT AS shards,
         row_number() OVER (ORDER BY any_value(source) IS NULL, any_value(source)) AS place,
         [5, 2, 1][((place - 1) % 3 + 1)::INT]::BIGINT AS weight,
         source_size * 2 AS cap, cap::DOUBLE / weight::DOUBLE AS ratio
  FROM sized GROUP BY source_key),
levels AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE * 150 / 100.0::DOUBLE AS budget,
         coalesce(sum(cap) OVER before, 0)::DOUBLE AS cap_before,
         (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS weight_left,
         (budget - cap_before) / weight_left AS level, ratio <= level AS is_full
  FROM ranked WINDOW before AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source_key, place, source_size, shards,
         CASE WHEN is_full OR final IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, weight * final) END AS target
  FROM (SELECT *, max(level) FILTER (NOT is_full) OVER () AS final FROM levels)),
seats AS (
  SELECT floor((sum(floor(target / 16 * 1000)::BIGINT) + 500) / 1000)::BIGINT AS n FROM targets WHERE target > 0),
blocks AS (
  SELECT source_key, count(*) AS b FROM (
    SELECT source_key, row_number() OVER (ORDER BY target / 16 / (2 * seat - 1) DESC, place, seat) AS r
    FROM (SELECT *, unnest(range(1, floor(target / 16)::BIGINT + 100)) AS seat FROM targets WHERE target > 0)), seats
  WHERE r <= n GROUP BY source_key),
dealt AS (
  SELECT s.*, t.source_size, t.target, ('0x' || draw[1:8])::BIGINT % t.shards AS shard
  FROM sized s JOIN targets t USING (source_key)),
supply AS (SELECT source_key, shard, sum(size)::BIGINT AS supply FROM dealt WHERE size > 0 GROUP BY ALL),
shares AS (
  SELECT *, b::DOUBLE * supply / sum(supply) OVER (PARTITION BY source_key) AS share
  FROM supply JOIN blocks USING (source_key)),
quotas AS (
  SELECT source_key, shard, count(*) AS quota FROM (
    SELECT source_key, shard, b,
           row_number() OVER (PARTITION BY source_key ORDER BY share / (2 * seat - 1) DESC, shard, seat) AS r
    FROM (SELECT *, unnest(range(1, floor(share)::BIGINT + 100)) AS seat FROM shares))
  WHERE r <= b GROUP BY ALL),
plan AS (
  SELECT s.source_key, s.shard, supply, least(coalesce(quota, 0) * 16, supply * 2)::BIGINT AS words,
         words // supply AS passes, words % supply AS run,
         ('0x' || md5('mix-1:' || s.source_key || ':' || s.shard)[1:8])::BIGINT % ceil(supply / 16)::BIGINT * 16 AS begins
  FROM supply s LEFT JOIN quotas q ON q.source_key = s.source_key AND q.shard = s.shard),
placed AS (
  SELECT *, (sum(size) OVER (PARTITION BY source_key, shard ORDER BY draw, size ROWS UNBOUNDED PRECEDING))::BIGINT AS e,
         e - size AS b FROM dealt WHERE size > 0)
SELECT d.doc_id, d.size, d.source_size, d.target,
       (passes * size + greatest(0, least(e, begins + run, supply) - greatest(b, begins))
         + greatest(0, least(e, begins + run - supply) - greatest(b, 0)))::BIGINT AS taken
FROM placed d JOIN plan p ON p.shard = d.shard AND p.source_key = d.source_key
UNION ALL SELECT doc_id, size, source_size, target, 0 FROM dealt WHERE size = 0
"""

ORACLE = {
    "op2_host_reputation": OP2,
    "op3_stream_exact_dedup": OP3,
    "op4_bloom_line_dedup": OP4,
    "op5_block_anchor_dedup": OP5,
    "op6_setsketch_near_dedup": OP6,
    "op9_line_frequency_quality": OP9,
    "op10_sainte_lague_mix": OP10,
}
