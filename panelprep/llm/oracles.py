"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

from panelprep.llm.url_filters import PRODUCTION_PATTERNS, PRODUCTION_RULES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rule_values() -> str:
    return ", ".join(f"('{verdict}', '{text}')" for verdict, text in PRODUCTION_RULES)


def _pattern_regex(pattern: str) -> str:
    body = pattern[2:] if pattern.startswith("||") else pattern
    start = r"^(?:[^/?#]*\.)?" if pattern.startswith("||") else ""
    return start + "".join(".*" if ch == "*" else "\\" + ch if ch in ".-/&" else ch for ch in body)


def _pattern_case() -> str:
    return " ".join(f"WHEN regexp_matches(low, '{_pattern_regex(p)}', 's') THEN '{p.lower()}'" for p in PRODUCTION_PATTERNS)


OP1 = rf"""
WITH cut AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*(/[^?#]*)', 1) AS path,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^?#]*(\?[^#]*)', 1) AS query
  FROM pages),
rules AS (SELECT col0 AS verdict, col1 AS rule FROM (VALUES {_rule_values()})),
parts AS (SELECT *, split_part(rule, '/', 1) AS rule_host, substr(rule, strpos(rule, '/')) AS rule_path FROM rules),
judged AS (
  SELECT c.*, lower(host || path || query) AS low,
         (SELECT max_by(struct_pack(rule := r.rule, verdict := r.verdict), length(r.rule)) FROM parts r
          WHERE (c.host = r.rule_host OR ends_with(c.host, '.' || r.rule_host)) AND starts_with(c.path, r.rule_path)) AS best
  FROM cut c),
matched AS (SELECT *, CASE {_pattern_case()} END AS pattern FROM judged)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.verdict, CASE WHEN pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict, pattern
FROM matched
"""

_BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(column: str) -> str:
    return f"regexp_extract_all(translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}'), '{_BENCH_WORD}')"


OP10 = f"""
WITH item_words AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words('text')} AS w FROM benchmark),
windows AS (
  SELECT item, w[s : s + 9] AS win FROM (
    SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS s FROM item_words WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(win) AS n FROM windows),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_words('text')} AS w FROM documents),
spots AS (
  SELECT r, n, s, w[s : s + n - 1] AS win FROM (
    SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM docs, lengths WHERE len(w) >= n)),
hits AS (SELECT spots.r, spots.s, spots.n, windows.item FROM spots JOIN windows USING (win)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

ORACLES = {"op1_url_filters": OP1, "op10_decontamination": OP10}
