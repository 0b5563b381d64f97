"""The production tree of ``documents``: domain, language, source.

``documents`` names no domain, so sources are grouped by their number here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def levels() -> dict[str, Column]:
    number = F.regexp_extract(F.coalesce(F.col("source"), F.lit("")), "^src([0-9]{1,6})\\z", 1)
    number = F.when(number != "", number).cast("int")
    domain = F.when(number < 8, "web").when(number < 14, "reference").when(number.isNotNull(), "forum").otherwise("other")
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


WEIGHTS = {"domain": {"web": 5, "reference": 3, "forum": 2, "*": 1}, "lang": {"en": 6, "de": 2, "fr": 2, "*": 1}, "source": {"*": 1}}
SEED = 42
MAX_EPOCHS = 4

_DOMAIN_SQL = """CASE WHEN n < 8 THEN 'web' WHEN n < 14 THEN 'reference' WHEN n IS NOT NULL THEN 'forum' ELSE 'other' END"""


def _level_sql(parent: str, children: str, keys: list[str], above: list[str], out: str) -> str:
    """SQL twin of one level's water filling: ``children`` has keys, c, w; ``parent`` has above, b."""
    part = "PARTITION BY " + ", ".join(f"x.{k}" for k in above) if above else ""
    on = " AND ".join(f"x.{k} = p.{k}" for k in above) or "true"
    k = ", ".join(keys)
    return f"""{out}_l AS (SELECT {', '.join('x.' + i for i in keys)}, x.c, x.w,
      (p.b - coalesce(sum(x.c) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
        / sum(x.w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS lev
      FROM {children} x JOIN {parent} p ON {on} WINDOW o AS ({part} ORDER BY x.c::DOUBLE / x.w::DOUBLE, x.{keys[-1]})),
    {out} AS (SELECT {k}, least(c::DOUBLE, max(lev) OVER ({part.replace('x.', '')}) * w) AS b FROM {out}_l)"""


ORACLE = f"""
WITH d0 AS (SELECT doc_id, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source, coalesce(text, '') AS text,
    TRY_CAST(regexp_extract(coalesce(source, ''), '^src([0-9]{{1,6}})\\z', 1) AS INT) AS n FROM documents),
d AS (SELECT doc_id, {_DOMAIN_SQL} AS domain, lang, source, md5(text) AS tie,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens FROM d0),
leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS t FROM d GROUP BY ALL HAVING sum(tokens) > 0),
root AS (SELECT sum(t)::DOUBLE AS b FROM leaf),
c1 AS (SELECT domain, sum({MAX_EPOCHS} * t)::BIGINT AS c, CASE domain WHEN 'web' THEN 5 WHEN 'reference' THEN 3 WHEN 'forum' THEN 2 ELSE 1 END::BIGINT AS w FROM leaf GROUP BY ALL),
c2 AS (SELECT domain, lang, sum({MAX_EPOCHS} * t)::BIGINT AS c, CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END::BIGINT AS w FROM leaf GROUP BY ALL),
c3 AS (SELECT domain, lang, source, sum({MAX_EPOCHS} * t)::BIGINT AS c, 1::BIGINT AS w FROM leaf GROUP BY ALL),
{_level_sql('root', 'c1', ['domain'], [], 'b1')},
{_level_sql('b1', 'c2', ['domain', 'lang'], ['domain'], 'b2')},
{_level_sql('b2', 'c3', ['domain', 'lang', 'source'], ['domain', 'lang'], 'b3')},
plan AS (SELECT domain, lang, source, t, floor(greatest(b, 0))::BIGINT AS b FROM b3 JOIN leaf USING (domain, lang, source)),
e AS (SELECT d.*, b // t AS whole, b - (b // t) * t AS room,
    md5('{SEED}:' || (b // t)::VARCHAR || ':' || coalesce(doc_id::VARCHAR, '')) AS o FROM d JOIN plan USING (domain, lang, source)),
r AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY o, tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM e)
SELECT doc_id, domain, lang, source, tokens, (whole + CASE WHEN run <= room THEN 1 ELSE 0 END)::INT AS copies
FROM r WHERE whole + CASE WHEN run <= room THEN 1 ELSE 0 END > 0"""
