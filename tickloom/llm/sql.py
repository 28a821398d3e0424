"""DuckDB SQL of the queries that it can express, and the production parameters of the mix."""

from __future__ import annotations

#: Production mix: the crawl, named web sources and the rest, by language; sources evenly.
MIX_DOMAINS = {"crawl": ("src0",), "web": tuple(f"src{i}" for i in range(1, 10))}
MIX_WEIGHTS = {
    "domain": {"crawl": 0.3, "web": 0.4, "curated": 0.3},
    "language": {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2, "": 0.1},
}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.9, 2, 17

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), " + r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _cases(column: str, values: dict[str, float]) -> str:
    cases = " ".join(f"WHEN {column} = '{k}' THEN CAST({v} AS DOUBLE)" for k, v in values.items())
    return f"CASE {cases} ELSE CAST(1.0 AS DOUBLE) END"


def _served(level: str, keys: str, children: str) -> str:
    """One level of the budget tree: ``children`` gives room, weight and parent_budget of each."""
    order = f"PARTITION BY {keys} ORDER BY room / weight, {level}"
    return f"""
      SELECT *, greatest(0.0, least(room, weight * max(lv) OVER (PARTITION BY {keys}))) AS budget FROM (
        SELECT *, (parent_budget - coalesce(sum(room) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
          / sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
        FROM ({children}))"""


_L1 = _served("domain", "root", f"""
  SELECT 0 AS root, domain, sum(room) AS room, max(w1) AS weight,
    (SELECT sum(tokens) * CAST({MIX_SHARE} AS DOUBLE) FROM leaves) AS parent_budget
  FROM rooms GROUP BY domain""")
_L2 = _served("language", "domain", """
  SELECT r.domain, r.language, sum(r.room) AS room, max(w2) AS weight, max(l1.budget) AS parent_budget
  FROM rooms r JOIN l1 ON r.domain = l1.domain GROUP BY r.domain, r.language""")
_L3 = _served("origin", "domain, language", """
  SELECT r.domain, r.language, r.origin, r.room, CAST(1.0 AS DOUBLE) AS weight, l2.budget AS parent_budget, r.tokens
  FROM rooms r JOIN l2 ON r.domain = l2.domain AND r.language = l2.language""")

QUERIES = {
    "op9_mix": f"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS language, coalesce(source, '') AS origin, lang, source,
    CASE WHEN source IN ('src0') THEN 'crawl'
         WHEN source IN ({", ".join(f"'{s}'" for s in MIX_DOMAINS["web"])}) THEN 'web' ELSE 'curated' END AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens
  FROM documents),
leaves AS (
  SELECT domain, language, origin, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM docs GROUP BY domain, language, origin),
rooms AS (
  SELECT *, {MIX_EPOCHS} * CAST(tokens AS DOUBLE) AS room, {_cases("domain", MIX_WEIGHTS["domain"])} AS w1,
    {_cases("language", MIX_WEIGHTS["language"])} AS w2
  FROM leaves),
l1 AS ({_L1}),
l2 AS ({_L2}),
l3 AS ({_L3}),
plan AS (
  SELECT domain, language, origin, CAST(floor(budget + 1e-6) AS BIGINT) // tokens AS full_epochs,
    CAST(floor(budget + 1e-6) AS BIGINT) % tokens AS rest
  FROM l3 WHERE tokens > 0),
ordered AS (
  SELECT d.*, full_epochs, rest, sum(n_tokens) OVER (PARTITION BY d.domain, d.language, d.origin
      ORDER BY md5('{MIX_SEED}:' || (full_epochs + 1) || ':' || doc_id)) AS upto
  FROM docs d JOIN plan p ON d.domain = p.domain AND d.language = p.language AND d.origin = p.origin)
SELECT doc_id, domain, lang, source, n_tokens,
  CAST(unnest(range(1, full_epochs + 1 + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)) AS INTEGER) AS epoch
FROM ordered""",
    "op10_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
runs AS (
  SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT runs.doc_id, runs.s, runs.size, win.item_id FROM runs JOIN win ON runs.g = win.g AND runs.size = win.size),
places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hits) GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places ON d.doc_id = places.doc_id LEFT JOIN ids ON d.doc_id = ids.doc_id""",
}
