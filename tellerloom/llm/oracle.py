"""DuckDB SQL for those queries of this folder that SQL can express."""

# Every order applied to every document, step by step, without coalitions.
FILTER_AUDIT = r"""
WITH marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
plain AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
first_of AS (SELECT text, min(doc_id) AS first_id FROM plain GROUP BY text),
failing AS (
  SELECT p.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         len(words) < 50 AS a,
         100 * len(list_distinct(words)) < 65 * len(words) AS b,
         100 * len(regexp_extract_all(p.text, '[A-Z]')) > 5 * length(p.text) AS c,
         regexp_matches(p.text, '[#$%&*|]') AS d,
         coalesce(p.doc_id > f.first_id, false) AS e
  FROM plain p JOIN first_of f USING (text) LEFT JOIN marks m USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
marked AS (
  SELECT part, good, toxic,
         [x FOR x IN [CASE WHEN a THEN 'A' END, CASE WHEN b THEN 'B' END, CASE WHEN c THEN 'C' END,
                      CASE WHEN d THEN 'D' END, CASE WHEN e THEN 'E' END] IF x IS NOT NULL] AS fails
  FROM failing),
gone AS (
  SELECT m.*, o.filter_order,
         list_min([instr(o.filter_order, x) FOR x IN m.fails]) AS gone_at
  FROM marked m CROSS JOIN orders o),
steps AS (SELECT unnest([1, 2, 3, 4, 5]) AS step),
told AS (
  SELECT g.part, g.filter_order, s.step, substr(g.filter_order, s.step, 1) AS filter,
         count(*) FILTER (gone_at IS NULL OR gone_at > s.step) AS kept,
         count(*) FILTER (gone_at = s.step) AS removed,
         count(*) FILTER (gone_at < s.step
           AND list_contains(fails, substr(g.filter_order, s.step, 1))) AS redundant,
         count(*) FILTER (fails = [substr(g.filter_order, s.step, 1)]) AS unique_fails,
         count(*) FILTER (gone_at = s.step AND good = 1) AS good_lost,
         count(*) FILTER (gone_at = s.step AND toxic = 1) AS toxic_lost
  FROM gone g CROSS JOIN steps s GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter, kept, removed, redundant,
       unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM told
"""

# The same rounds as a recursive query, each over all hosts and both directions at once.
URL_VERDICTS = r"""
WITH RECURSIVE rules(verdict, rule, name, start) AS (
  VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
         ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
found AS (
  SELECT page_id, row_number() OVER () AS place, coalesce(url, '') AS url,
         list_distinct(regexp_extract_all(coalesce(html, ''),
           '(?i)<a\s[^>]*?href\s*=\s*["'']?\s*((?:https?:)?//[^\s"''<>]+)', 1)) AS links
  FROM pages),
urls AS (
  SELECT place, true AS is_page, url FROM found
  UNION ALL
  SELECT place, false, CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END
  FROM (SELECT place, unnest(links) AS link FROM found)),
split AS (
  SELECT DISTINCT place, is_page, url,
         translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM urls),
ruled AS (
  SELECT s.*, r.rule, r.verdict
  FROM split s LEFT JOIN LATERAL (
    SELECT rule, verdict FROM rules
    WHERE (s.host = name OR ends_with(s.host, '.' || name)) AND starts_with(s.path, start)
    ORDER BY length(rule) DESC LIMIT 1) r ON true),
seeds AS (
  SELECT kind, host, base FROM (
    SELECT 'trust' AS kind, host,
           count(*) FILTER (verdict = 'allow') * 15000000 // (count(*) * 100) AS base
    FROM ruled WHERE host <> '' GROUP BY host
    UNION ALL
    SELECT 'distrust', host, count(*) FILTER (verdict = 'block') * 15000000 // (count(*) * 100)
    FROM ruled WHERE host <> '' GROUP BY host)
  WHERE base > 0),
edges AS (
  SELECT DISTINCT p.host AS source, l.host AS target
  FROM ruled p JOIN ruled l ON p.place = l.place AND p.is_page AND NOT l.is_page
  WHERE p.host <> '' AND l.host <> '' AND p.host <> l.host),
flows AS (
  SELECT 'trust' AS kind, source AS host, target AS dest,
         count(*) OVER (PARTITION BY source) AS degree FROM edges
  UNION ALL
  SELECT 'distrust', target, source, count(*) OVER (PARTITION BY target) FROM edges),
scores AS (
  SELECT 0 AS round, kind, host, CAST(base AS BIGINT) AS score FROM seeds
  UNION ALL
  SELECT round, kind, host, CAST(sum(score) AS BIGINT)
  FROM (SELECT s.round + 1 AS round, f.kind, f.dest AS host, s.score * 85 // (f.degree * 100) AS score
        FROM scores s JOIN flows f ON s.kind = f.kind AND s.host = f.host WHERE s.round < 40
        UNION ALL
        SELECT r.round + 1, b.kind, b.host, b.base
        FROM (SELECT DISTINCT round FROM scores WHERE round < 40) r, seeds b)
  GROUP BY round, kind, host),
hosts AS (
  SELECT host, sum(score) FILTER (kind = 'trust') AS trust,
         sum(score) FILTER (kind = 'distrust') AS distrust
  FROM scores WHERE round = 40 GROUP BY host)
SELECT f.page_id, r.host, r.path, r.rule,
       coalesce(r.verdict, CASE WHEN coalesce(distrust, 0) >= 75000
         AND coalesce(distrust, 0) > coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(coalesce(trust, 0) AS BIGINT) AS trust, CAST(coalesce(distrust, 0) AS BIGINT) AS distrust
FROM found f JOIN ruled r ON f.place = r.place AND r.is_page LEFT JOIN hosts h ON h.host = r.host
"""
