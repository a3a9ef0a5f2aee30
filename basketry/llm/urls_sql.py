"""DuckDB SQL of the URL filter: the same rules and the same steps, one CTE per step."""

from basketry.llm.urls import LINK, RULES

STEPS, DAMPING = 12, 0.85


def _rule(column: str) -> str:
    ordered = sorted(RULES, key=lambda r: (-len(r.text), r.verdict != "block", r.text))
    whens = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
        f"THEN '{getattr(r, column)}'" for r in ordered)
    return f"CASE {whens} END"


def url_filter_sql() -> str:
    link = LINK.replace("'", "''")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    steps = "".join(f"""
, s{i} AS MATERIALIZED (SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM (
    SELECT f.dst AS host, s.trust * f.tw AS trust, s.distrust * f.dw AS distrust
    FROM s{i - 1} s JOIN flows f ON s.host = f.src
    UNION ALL SELECT host, trust * {1 - DAMPING}, distrust * {1 - DAMPING} FROM s0) GROUP BY host)"""
                    for i in range(1, STEPS + 1))
    return f"""
WITH rest AS (
  SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3)
                        ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*', 0), '{upper}', '{lower}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
judged AS (SELECT page_id, host, path, {_rule('text')} AS rule, {_rule('verdict')} AS rule_verdict
           FROM parts),
found AS (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)),
                                        '{upper}', '{lower}') AS dst FROM parts),
links AS (SELECT src, dst, count(*) AS n FROM found GROUP BY ALL),
known AS (SELECT src AS h FROM links UNION SELECT dst FROM links UNION SELECT host FROM parts),
parent AS (SELECT h, regexp_extract(h, '^[^.]+\\.([^.]+\\..+)$', 1) AS p FROM known),
edges AS (SELECT src, dst, sum(n) AS n FROM (
    SELECT src, dst, n FROM links UNION ALL SELECT h, p, 1 FROM parent WHERE p <> ''
    UNION ALL SELECT p, h, 1 FROM parent WHERE p <> '')
  WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY src, dst),
flows AS MATERIALIZED (SELECT src, dst, sum(tw) AS tw, sum(dw) AS dw FROM (
    SELECT src, dst, n / sum(n) OVER (PARTITION BY src) * {DAMPING} AS tw, 0.0 AS dw FROM edges
    UNION ALL
    SELECT dst, src, 0.0, n / sum(n) OVER (PARTITION BY dst) * {DAMPING} FROM edges)
  GROUP BY src, dst),
s0 AS MATERIALIZED (SELECT host, avg(CASE WHEN rule_verdict = 'allow' THEN 1.0 ELSE 0.0 END) AS trust,
              avg(CASE WHEN rule_verdict = 'block' THEN 1.0 ELSE 0.0 END) AS distrust
       FROM judged WHERE host <> '' GROUP BY host){steps},
hosts AS (SELECT host, CASE WHEN round(
    distrust / (SELECT CASE WHEN sum(distrust) = 0 THEN 1 ELSE sum(distrust) END FROM s{STEPS})
    - trust / (SELECT CASE WHEN sum(trust) = 0 THEN 1 ELSE sum(trust) END FROM s{STEPS}), 9) > 0
    THEN 'block' ELSE 'allow' END AS host_verdict FROM s{STEPS})
SELECT page_id, host, path, rule, coalesce(rule_verdict, host_verdict, 'allow') AS verdict
FROM judged LEFT JOIN hosts USING (host)
"""
