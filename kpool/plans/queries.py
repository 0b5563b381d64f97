"""Registered queries over the driver tables, each paired with an
independent DuckDB SQL formulation (``ORACLE``).

Every query reads whole tables.  Samples are reproducible because all
randomness comes from md5 tags with the same text form in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpool.functions.tags import sql_draw, sql_id_text, sql_priority
from kpool.operators.audit import count_by, inclusion_audit, parity
from kpool.operators.merge import merge_sides, merge_summaries, merge_weighted
from kpool.operators.ordinal import ordinal
from kpool.operators.pairing import pair_latest_unmatched
from kpool.operators.reservoir import (reservoir_as_of, reservoir_by_key, reservoir_history, reservoir_replay,
                                      reservoir_summary, reservoir_update)
from kpool.operators import summary as R
from kpool.operators.sample import PRIORITY, RANK, sample_by_key, sample_k
from kpool.operators.summary import build_summary, explode_summary, render_summary
from kpool.plans.layout import materialize
from kpool.sources.generators import random_strings

SEED = 42

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Identity of a lineitem row (the four keys alone repeat at the smallest scale).
LI_IDS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
LI_PRI_SQL = sql_priority(SEED, *[sql_id_text(c) for c in LI_IDS[:4]], sql_id_text("l_shipdate", "ts"))
LI_ORDER_SQL = "priority, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate"


def _pri_sql(col: str, seed: int = SEED) -> str:
    return sql_priority(seed, sql_id_text(col))


# ---------------------------------------------------------------- A3: sample_k
def _sample_k(spark, sf_dir, strategy="auto"):
    li = table(spark, sf_dir, "lineitem").select(*LI_IDS, "l_extendedprice")
    s = sample_k(li, 500, LI_IDS, seed=SEED, strategy=strategy)
    return s.select(PRIORITY, RANK, "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")


_SAMPLE_K_SQL = f"""
SELECT priority, CAST(row_number() OVER (ORDER BY {LI_ORDER_SQL}) AS BIGINT) AS sample_rank,
       l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice
FROM (SELECT {LI_PRI_SQL} AS priority, * FROM lineitem)
ORDER BY {LI_ORDER_SQL} LIMIT 500
"""
register("sample_k", _SAMPLE_K_SQL)(lambda spark, sf: _sample_k(spark, sf))
register("sample_k_pruned", _SAMPLE_K_SQL)(lambda spark, sf: _sample_k(spark, sf, "prune"))


# ------------------------------------------------------ A5 P1 P3: sample_by_key
def _sample_by_key(spark, sf_dir, strategy="auto"):
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    s = sample_by_key(ev, ["event_type"], 50, ["event_id"], seed=SEED, strategy=strategy)
    return s.select("event_type", RANK, PRIORITY, "event_id", "user_id")


_SAMPLE_BY_KEY_SQL = f"""
SELECT event_type, sample_rank, priority, event_id, user_id FROM (
  SELECT event_type, priority, event_id, user_id,
         CAST(row_number() OVER (PARTITION BY event_type ORDER BY priority, event_id) AS BIGINT) AS sample_rank
  FROM (SELECT {_pri_sql('event_id')} AS priority, * FROM events))
WHERE sample_rank <= 50
"""
register("sample_by_key", _SAMPLE_BY_KEY_SQL)(lambda spark, sf: _sample_by_key(spark, sf))
register("sample_by_key_pruned", _SAMPLE_BY_KEY_SQL)(lambda spark, sf: _sample_by_key(spark, sf, "prune"))


# ----------------------------------------------------------- F1 A1 X1: split_counts
@register("split_counts", """
SELECT CASE WHEN ((o_orderkey % 2) + 2) % 2 = 1 THEN 'odd' ELSE 'even' END AS source,
       CAST(count(*) AS BIGINT) AS cnt
FROM orders GROUP BY 1
""")
def q_split_counts(spark, sf_dir):
    return count_by(table(spark, sf_dir, "orders"), parity("o_orderkey"), "source", "cnt")


# ------------------------------------------------------------ A6 A1: summary_build
@register("summary_build", f"""
SELECT event_type, n, CAST(10 AS BIGINT) AS k, sample_rank, priority, event_id AS value FROM (
  SELECT event_type, priority, event_id,
         count(*) OVER (PARTITION BY event_type) AS n,
         CAST(row_number() OVER (PARTITION BY event_type ORDER BY priority, event_id) AS BIGINT) AS sample_rank
  FROM (SELECT {_pri_sql('event_id')} AS priority, * FROM events))
WHERE sample_rank <= 10
""")
def q_summary_build(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    summ = build_summary(ev, ["event_type"], 10, "event_id", ["event_id"], seed=SEED)
    return explode_summary(summ, ["event_type"]).select(
        "event_type", "n", "k", RANK, PRIORITY, "value")


# --------------------------------------------------------- A7 A8 F1: merge_priority
def _merge_priority_items(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    halves = build_summary(orders.withColumn("half", parity("o_orderkey")), ["half"], 300, "o_orderkey", ["o_orderkey"], seed=SEED)
    merged = merge_summaries(halves, [], 200)
    return explode_summary(merged, [])


_TOP200_ORDERS = f"""
SELECT priority, o_orderkey AS value,
       CAST(row_number() OVER (ORDER BY priority, o_orderkey) AS BIGINT) AS sample_rank,
       (SELECT count(*) FROM orders) AS n
FROM (SELECT {_pri_sql('o_orderkey')} AS priority, o_orderkey FROM orders)
ORDER BY priority, o_orderkey LIMIT 200
"""


@register("merge_priority", f"""
SELECT n, CAST(200 AS BIGINT) AS k, sample_rank, priority, value FROM ({_TOP200_ORDERS})
""")
def q_merge_priority(spark, sf_dir):
    return _merge_priority_items(spark, sf_dir).select("n", "k", RANK, PRIORITY, "value")


# ------------------------------------------------------------- A2 F2: merge_provenance
@register("merge_provenance", f"""
SELECT CASE WHEN ((value % 2) + 2) % 2 = 1 THEN 'odd' ELSE 'even' END AS source,
       CAST(count(*) AS BIGINT) AS cnt
FROM ({_TOP200_ORDERS}) GROUP BY 1
""")
def q_merge_provenance(spark, sf_dir):
    return count_by(_merge_priority_items(spark, sf_dir), parity("value"), "source", "cnt")


# -------------------------------------------------------- A8 A12 P2: merge_rollup
@register("merge_rollup", f"""
SELECT l_returnflag, n, CAST(50 AS BIGINT) AS k, sample_rank, priority,
       l_orderkey, l_partkey, l_suppkey, l_linenumber FROM (
  SELECT *, count(*) OVER (PARTITION BY l_returnflag) AS n,
         CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY {LI_ORDER_SQL}) AS BIGINT) AS sample_rank
  FROM (SELECT {LI_PRI_SQL} AS priority, * FROM lineitem))
WHERE sample_rank <= 50
""")
def q_merge_rollup(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", *LI_IDS)
    fine = build_summary(li, ["l_returnflag", "l_linestatus"], 50,
                         ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], LI_IDS, seed=SEED)
    coarse = merge_summaries(fine, ["l_returnflag"], 50)
    ex = explode_summary(coarse, ["l_returnflag"])
    return ex.select("l_returnflag", "n", "k", RANK, PRIORITY,
                     *[F.col(f"value.{c}").alias(c) for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]])


# ------------------------------------------------------------ A7: merge_weighted
_MW_M = 20
_MW_K = 20


@register("merge_weighted", f"""
WITH RECURSIVE
 cust AS (
   SELECT c_custkey, CAST(n_regionkey AS BIGINT) AS r_regionkey, c_nationkey % 2 AS side, {_pri_sql('c_custkey')} AS priority,
          row_number() OVER (PARTITION BY n_regionkey, c_nationkey % 2 ORDER BY {_pri_sql('c_custkey')}, c_custkey) AS rk
   FROM customer JOIN nation ON n_nationkey = c_nationkey),
 stat AS (SELECT r_regionkey, count(*) FILTER (side = 0) AS n1, count(*) FILTER (side = 1) AS n2 FROM cust GROUP BY r_regionkey),
 params AS (
   SELECT *, least({_MW_M}, n1 + n2, CASE WHEN n1 > {_MW_K} THEN {_MW_K} END, CASE WHEN n2 > {_MW_K} THEN {_MW_K} END) AS m_eff FROM stat),
 fold(r_regionkey, i, a, b, c1, c2, m_eff) AS (
   SELECT r_regionkey, 0, n1, n2, 0, 0, m_eff FROM params
   UNION ALL
   SELECT r_regionkey, i + 1, a - l, b - (1 - l), c1 + l, c2 + (1 - l), m_eff FROM (
     SELECT *, CASE WHEN {sql_draw(SEED, 'merge', sql_id_text('r_regionkey'), 'i + 1', bound='a + b')} < a THEN 1 ELSE 0 END AS l
     FROM fold WHERE i < m_eff))
SELECT f.r_regionkey, c.side, c.c_custkey, CAST(p.n1 + p.n2 AS BIGINT) AS n, CAST(p.m_eff AS BIGINT) AS k
FROM fold f JOIN params p ON f.r_regionkey = p.r_regionkey AND f.i = p.m_eff
JOIN cust c ON c.r_regionkey = f.r_regionkey AND c.rk <= CASE WHEN c.side = 0 THEN f.c1 ELSE f.c2 END
""")
def q_merge_weighted(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").cast("bigint").alias("r_regionkey"))
    cust = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    cust = cust.select("c_custkey", "r_regionkey", (F.col("c_nationkey") % 2).alias("side"))
    halves = build_summary(cust, ["r_regionkey", "side"], _MW_K, ["c_custkey", "side"], ["c_custkey"], seed=SEED)
    even, odd = (halves.filter(F.col("side") == i).drop("side") for i in (0, 1))
    merged = merge_weighted(even, odd, ["r_regionkey"], _MW_M, seed=SEED)
    return explode_summary(merged, ["r_regionkey"]).select("r_regionkey", "value.side", "value.c_custkey", "n", "k")


# --------------------------------------------------------- S1 F1 A7: range_merge_demo
# The integer set split by parity, from the ids of a given table.
@register("range_merge_demo", f"""
SELECT priority, id, CAST(row_number() OVER (ORDER BY priority, id) AS BIGINT) AS sample_rank,
       (SELECT count(*) FROM part) AS n, CAST(200 AS BIGINT) AS k
FROM (SELECT {_pri_sql('p_partkey')} AS priority, p_partkey AS id FROM part)
ORDER BY priority, id LIMIT 200
""")
def q_range_merge_demo(spark, sf_dir):
    ids = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    halves = build_summary(ids.withColumn("half", parity("id")), ["half"], 300, "id", ["id"], seed=SEED)
    return explode_summary(merge_summaries(halves, [], 200), []).select(PRIORITY, F.col("value").alias("id"), RANK, "n", "k")


def _render_sql(n: str, k: str, size: str, items: str) -> str:
    """A rendered summary, spelled with the fixed values of ``summary.py``."""
    return (f"'SamplePool{R.RENDER_AT}{R.RENDER_STREAM}' || {n} || ' {R.RENDER_SAMPLE}' || {k} || ' {R.RENDER_DATA_SIZE}' || {size} "
            f"|| ' {R.RENDER_DATA}' || coalesce({items}, '') || '{R.RENDER_END}'")


# --------------------------------------------------------- A11 S5 X4: summary_render
@register("summary_render", f"""
SELECT p_brand, {_render_sql('max(n)', '5', 'count(*)', "string_agg(coalesce(p_name, 'null'), ', ' ORDER BY priority, p_partkey)")} AS text
FROM (
  SELECT p_brand, p_name, p_partkey, priority, count(*) OVER (PARTITION BY p_brand) AS n,
         row_number() OVER (PARTITION BY p_brand ORDER BY priority, p_partkey) AS rk
  FROM (SELECT {_pri_sql('p_partkey')} AS priority, * FROM part))
WHERE rk <= 5 GROUP BY p_brand
""")
def q_summary_render(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    summ = build_summary(part, ["p_brand"], 5, "p_name", ["p_partkey"], seed=SEED)
    return summ.select("p_brand", render_summary(F.col("n"), F.col("k"), F.col("items")).alias("text"))


# -------------------------------------------------------------- S3 X3: random_strings
@register("random_strings", f"""
SELECT event_id, array_to_string(list_transform(range(1, len + 1),
         lambda i: chr(CAST(97 + {sql_draw(1, 'letter', sql_id_text('event_id'), 'i', bound='26')} AS INTEGER))), '') AS text
FROM (SELECT event_id, 1 + {sql_draw(1, 'len', sql_id_text('event_id'), bound='10')} AS len FROM events)
""")
def q_random_strings(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id")
    return random_strings(ev, ["event_id"], seed=1)


# ---------------------------------------- S3 A6 A8 A11: random_string_merge_render
# The reference's two-source demo as a batch query: random strings for the
# clicks (seed 1) and all other events (seed 2), sampled with k=10 and
# k=15, merged with m=20 (Rule R lowers it to 10), each summary rendered.
def _rs_sql(seed: int, kind: str) -> str:
    return f"""
    SELECT event_id, {_pri_sql('event_id')} AS priority,
           array_to_string(list_transform(range(1, len + 1),
             lambda i: chr(CAST(97 + {sql_draw(seed, 'letter', sql_id_text('event_id'), 'i', bound='26')} AS INTEGER))), '')
             AS val
    FROM (SELECT event_id, 1 + {sql_draw(seed, 'len', sql_id_text('event_id'), bound='10')} AS len
          FROM events WHERE {kind})"""


@register("random_string_merge_render", f"""
WITH c AS (SELECT *, row_number() OVER (ORDER BY priority, event_id) AS rk FROM ({_rs_sql(1, "event_type = 'click'")})),
     v AS (SELECT *, row_number() OVER (ORDER BY priority, event_id) AS rk FROM ({_rs_sql(2, "event_type <> 'click'")})),
     cs AS (SELECT count(*) AS n FROM c),
     vs AS (SELECT count(*) AS n FROM v),
     mm AS (SELECT cs.n + vs.n AS n,
                   least(20, CASE WHEN cs.n > 10 THEN 10 END, CASE WHEN vs.n > 15 THEN 15 END) AS m
            FROM cs, vs),
     pooled AS (SELECT val, priority, event_id,
                       row_number() OVER (ORDER BY priority, event_id) AS rk
                FROM (SELECT * FROM c WHERE rk <= 10 UNION ALL SELECT * FROM v WHERE rk <= 15))
SELECT 'sampled1' AS kind,
       {_render_sql('(SELECT n FROM cs)', '10', 'count(*)', "string_agg(val, ', ' ORDER BY priority, event_id)")} AS text
FROM c WHERE rk <= 10
UNION ALL
SELECT 'sampled2' AS kind,
       {_render_sql('(SELECT n FROM vs)', '15', 'count(*)', "string_agg(val, ', ' ORDER BY priority, event_id)")} AS text
FROM v WHERE rk <= 15
UNION ALL
SELECT 'merged' AS kind,
       {_render_sql('(SELECT n FROM mm)', '(SELECT m FROM mm)', 'count(*)',
                    "string_agg(val, ', ' ORDER BY priority, event_id)")} AS text
FROM pooled WHERE rk <= (SELECT m FROM mm)
""")
def q_random_string_merge_render(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "event_type")
    sides = []
    click = F.col("event_type") == "click"
    for seed, side, k in ((1, click, 10), (2, ~click, 15)):
        strings = random_strings(ev.filter(side), ["event_id"], seed=seed)
        sides.append(build_summary(strings, [], k, "text", ["event_id"], seed=SEED))
    merged = merge_summaries(sides[0].unionByName(sides[1]), [], 20)
    rendered = [summ.select(F.lit(kind).alias("kind"),
                            render_summary(F.col("n"), F.col("k"), F.col("items")).alias("text"))
                for kind, summ in (("sampled1", sides[0]), ("sampled2", sides[1]), ("merged", merged))]
    return rendered[0].unionByName(rendered[1]).unionByName(rendered[2])


# ------------------------------------------------------------ A4: reservoir queries
_RES_K = 100


def _replay_sql(k: int, keys: str | None = None, upto: str | None = None) -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    where = f"WHERE n <= {upto}" if upto else ""
    return f"""
    SELECT *, CASE WHEN n <= {k} THEN n
                   ELSE 1 + {sql_draw(SEED, 'slot', "''", *([sql_id_text(keys)] if keys else []), 'n', bound='n')} END AS slot
    FROM (SELECT *, row_number() OVER ({part}ORDER BY ts, event_id) AS n FROM events) {where}
    """


@register("reservoir_replay", f"""
SELECT CAST(slot AS BIGINT) AS slot, CAST(max(n) AS BIGINT) AS n, arg_max(event_id, n) AS event_id
FROM ({_replay_sql(_RES_K)}) WHERE slot <= {_RES_K} GROUP BY slot
""")
def q_reservoir_replay(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    return reservoir_replay(ev, _RES_K, ["ts", "event_id"], ["event_id"], seed=SEED)


@register("reservoir_by_key", f"""
SELECT user_id, CAST(slot AS BIGINT) AS slot, CAST(max(n) AS BIGINT) AS n, arg_max(event_id, n) AS event_id
FROM ({_replay_sql(10, 'user_id')}) WHERE slot <= 10 GROUP BY user_id, slot
""")
def q_reservoir_by_key(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return reservoir_by_key(ev, ["user_id"], 10, ["ts", "event_id"], ["event_id"], seed=SEED)


@register("reservoir_history", f"""
SELECT CAST(slot AS BIGINT) AS slot, CAST(n AS BIGINT) AS from_n,
       CAST(lead(n) OVER (PARTITION BY slot ORDER BY n) - 1 AS BIGINT) AS to_n, event_id
FROM ({_replay_sql(_RES_K)}) WHERE slot <= {_RES_K}
""")
def q_reservoir_history(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    return reservoir_history(ev, _RES_K, ["ts", "event_id"], ["event_id"], seed=SEED)


@register("reservoir_as_of", f"""
SELECT CAST(slot AS BIGINT) AS slot, CAST(max(n) AS BIGINT) AS from_n, arg_max(event_id, n) AS event_id
FROM ({_replay_sql(_RES_K, upto='(SELECT count(*) // 2 FROM events)')}) WHERE slot <= {_RES_K} GROUP BY slot
""")
def q_reservoir_as_of(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    half = ev.count() // 2
    hist = reservoir_history(ev, _RES_K, ["ts", "event_id"], ["event_id"], seed=SEED)
    return reservoir_as_of(hist, half).select("slot", "from_n", "event_id")


# ----------------------------------------------- A4 + A8 + D6: reservoir_merge_weighted
# Per user: the reservoir of clicks (k=10) and that of all other events (k=15), filled
# by slot replacement in (ts, event_id) order, merged with the weighted
# algorithm into m=20 items after a seeded permutation of each slot order.
def _rmw_side_sql(kind: str, k: int, side: str) -> str:
    kt = sql_id_text("user_id")
    return f"""
    SELECT user_id, event_id, n_all,
           row_number() OVER (PARTITION BY user_id ORDER BY
             md5(concat_ws(':', '{SEED}', 'perm', {kt} || '|{side}', CAST(slot - 1 AS VARCHAR)))) AS pos
    FROM (
      SELECT user_id, slot, arg_max(event_id, n) AS event_id, max(n_all) AS n_all
      FROM (
        SELECT *, CASE WHEN n <= {k} THEN n
                       ELSE 1 + {sql_draw(SEED, 'slot', f"'{side}'", sql_id_text('user_id'), 'n', bound='n')} END AS slot
        FROM (SELECT user_id, event_id,
                     row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n,
                     count(*) OVER (PARTITION BY user_id) AS n_all
              FROM events WHERE {kind}))
      WHERE slot <= {k} GROUP BY user_id, slot)"""


_RMW_SQL = f"""
WITH RECURSIVE
 l AS ({_rmw_side_sql("event_type = 'click'", 10, 'L')}),
 r AS ({_rmw_side_sql("event_type <> 'click'", 15, 'R')}),
 ls AS (SELECT user_id, max(n_all) AS n1, count(*) AS s1 FROM l GROUP BY user_id),
 rs AS (SELECT user_id, max(n_all) AS n2, count(*) AS s2 FROM r GROUP BY user_id),
 params AS (
   SELECT coalesce(ls.user_id, rs.user_id) AS user_id, coalesce(n1, 0) AS n1, coalesce(n2, 0) AS n2,
          least(20, coalesce(n1, 0) + coalesce(n2, 0),
                CASE WHEN coalesce(n1, 0) > coalesce(s1, 0) THEN 10 END,
                CASE WHEN coalesce(n2, 0) > coalesce(s2, 0) THEN 15 END) AS m_eff
   FROM ls FULL OUTER JOIN rs ON ls.user_id = rs.user_id),
 fold(user_id, i, a, b, c1, c2, m_eff) AS (
   SELECT user_id, 0, n1, n2, 0, 0, m_eff FROM params
   UNION ALL
   SELECT user_id, i + 1,
          CASE WHEN {sql_draw(SEED, 'merge', sql_id_text('user_id'), 'i + 1', bound='a + b')} < a THEN a - 1 ELSE a END,
          CASE WHEN {sql_draw(SEED, 'merge', sql_id_text('user_id'), 'i + 1', bound='a + b')} < a THEN b ELSE b - 1 END,
          CASE WHEN {sql_draw(SEED, 'merge', sql_id_text('user_id'), 'i + 1', bound='a + b')} < a THEN c1 + 1 ELSE c1 END,
          CASE WHEN {sql_draw(SEED, 'merge', sql_id_text('user_id'), 'i + 1', bound='a + b')} < a THEN c2 ELSE c2 + 1 END,
          m_eff
   FROM fold WHERE i < m_eff),
 final AS (SELECT f.user_id, f.c1, f.c2, p.n1 + p.n2 AS n, p.m_eff
           FROM fold f JOIN params p ON f.user_id = p.user_id WHERE f.i = p.m_eff)
SELECT f.user_id, x.event_id, CAST(f.n AS BIGINT) AS n, CAST(f.m_eff AS BIGINT) AS k
FROM final f JOIN (SELECT user_id, event_id, pos, 'L' AS side FROM l
                   UNION ALL SELECT user_id, event_id, pos, 'R' AS side FROM r) x
  ON x.user_id = f.user_id AND ((x.side = 'L' AND x.pos <= f.c1) OR (x.side = 'R' AND x.pos <= f.c2))
"""


@register("reservoir_merge_weighted", _RMW_SQL)
def q_reservoir_merge_weighted(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    clicks = reservoir_summary(ev.filter(F.col("event_type") == "click"), ["user_id"], 10,
                               ["ts", "event_id"], "event_id", seed=SEED, salt="L")
    others = reservoir_summary(ev.filter(F.col("event_type") != "click"), ["user_id"], 15,
                               ["ts", "event_id"], "event_id", seed=SEED, salt="R")
    merged = merge_weighted(clicks, others, ["user_id"], 20, seed=SEED)
    return explode_summary(merged, ["user_id"]).select("user_id", F.col("value").alias("event_id"), "n", "k")


# ------------------------------------------------------- J1: pair_latest_unmatched
# The pairing state machine, one step per element (a recursive CTE): a
# different formulation from the window / ordinal plans it checks.
_J1_CTES = """
 e AS (SELECT user_id, event_id, event_type = 'click' AS is_left,
              row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
       FROM events),
 sm(user_id, rn, held_id, held_left, out_left, out_right, out_rf) AS (
   SELECT user_id, rn, event_id, is_left, NULL::BIGINT, NULL::BIGINT, NULL::BOOLEAN FROM e WHERE rn = 1
   UNION ALL
   SELECT e.user_id, e.rn,
          CASE WHEN sm.held_id IS NOT NULL AND sm.held_left <> e.is_left THEN NULL ELSE e.event_id END,
          CASE WHEN sm.held_id IS NOT NULL AND sm.held_left <> e.is_left THEN NULL ELSE e.is_left END,
          CASE WHEN sm.held_id IS NOT NULL AND sm.held_left <> e.is_left
               THEN CASE WHEN e.is_left THEN e.event_id ELSE sm.held_id END END,
          CASE WHEN sm.held_id IS NOT NULL AND sm.held_left <> e.is_left
               THEN CASE WHEN e.is_left THEN sm.held_id ELSE e.event_id END END,
          CASE WHEN sm.held_id IS NOT NULL AND sm.held_left <> e.is_left THEN e.is_left END
   FROM sm JOIN e ON e.user_id = sm.user_id AND e.rn = sm.rn + 1)"""


@register("pair_latest_unmatched", f"""
WITH RECURSIVE{_J1_CTES}
SELECT user_id, out_left AS left_id, out_right AS right_id, out_rf AS right_first
FROM sm WHERE out_left IS NOT NULL
""")
def q_pair_latest_unmatched(spark, sf_dir, num_partitions=None):
    ev = table(spark, sf_dir, "events")
    side = F.col("event_type") == "click"
    return pair_latest_unmatched(ev, ["user_id"], side, ["ts", "event_id"], "event_id", num_partitions)


# the same rows in many slices, so that keys span partitions at any size
register("pair_latest_unmatched_distributed", ORACLE["pair_latest_unmatched"])(
    lambda spark, sf: q_pair_latest_unmatched(spark, sf, 64))


# ------------------------------------------------------------ §5: inclusion_audit
_AUDIT_K = 20
_AUDIT_SEEDS = 100


@register("inclusion_audit", f"""
WITH tagged AS (
  SELECT p_partkey, s.seed,
         row_number() OVER (PARTITION BY s.seed
                            ORDER BY md5(concat_ws(':', CAST(s.seed AS VARCHAR), {sql_id_text('p_partkey')})), p_partkey) AS rk
  FROM part, (SELECT generate_series AS seed FROM generate_series(1, {_AUDIT_SEEDS})) s)
SELECT p.p_partkey, CAST(coalesce(t.times, 0) AS BIGINT) AS times
FROM part p LEFT JOIN (SELECT p_partkey, count(*) AS times FROM tagged WHERE rk <= {_AUDIT_K} GROUP BY p_partkey) t
  ON p.p_partkey = t.p_partkey
""")
def q_inclusion_audit(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return inclusion_audit(part, _AUDIT_K, ["p_partkey"], _AUDIT_SEEDS)


# ------------------------------------------------------------ T1 S4: stream queries
def _event_stream(spark, sf_dir):
    from kpool.sources.messages import read_messages

    schema = table(spark, sf_dir, "events").schema
    return read_messages(spark, "parquet", {"pathGlobFilter": "events.parquet"}, schema=schema, path=sf_dir)


@register("stream_sample", ORACLE["summary_build"])
def q_stream_sample(spark, sf_dir):
    from kpool.streaming.sample_stream import latest_summary, run_to_end, stream_sample

    q, tdir = stream_sample(_event_stream(spark, sf_dir), ["event_type"], 10, "event_id", ["event_id"], seed=SEED)
    run_to_end(q)
    return explode_summary(latest_summary(spark, tdir), ["event_type"]).select(
        "event_type", "n", "k", RANK, PRIORITY, "value")


@register("stream_sample_salted", ORACLE["summary_build"])
def q_stream_sample_salted(spark, sf_dir):
    """Each key kept as 8 sub-keys, merged on read: the same samples."""
    from kpool.streaming.sample_stream import merged_summary, run_to_end, stream_sample

    q, tdir = stream_sample(_event_stream(spark, sf_dir), ["event_type"], 10, "event_id", ["event_id"], seed=SEED, salt=8)
    run_to_end(q)
    return explode_summary(merged_summary(spark, tdir, ["event_type"], 10), ["event_type"]).select(
        "event_type", "n", "k", RANK, PRIORITY, "value")


@register("stream_merge", f"""
SELECT priority, event_id AS value,
       CAST(row_number() OVER (ORDER BY priority, event_id) AS BIGINT) AS sample_rank,
       (SELECT count(*) FROM events) AS n,
       CAST(20 AS BIGINT) AS k
FROM (SELECT {_pri_sql('event_id')} AS priority, event_id FROM events)
ORDER BY priority, event_id LIMIT 20
""")
def q_stream_merge(spark, sf_dir):
    from kpool.streaming.sample_stream import run_to_end, stream_merge, stream_sample

    ev = _event_stream(spark, sf_dir)
    click = F.col("event_type") == "click"
    started = [stream_sample(ev.filter(side), [], 20, "event_id", ["event_id"], seed=SEED)
               for side in (click, ~click)]  # both streams run at the same time
    for q, _ in started:
        run_to_end(q)
    merged = stream_merge(spark, [tdir for _, tdir in started], [], 20)
    return explode_summary(merged, []).select(PRIORITY, F.col("value"), RANK, "n", "k")


def _prefix_sample_sql(kind: str, k: int, bound: str) -> str:
    """Sample of one user's `kind` events up to and including the paired
    element (ts, id) of `lp` -- the summary the paired stream held at that time."""
    return f"""
    SELECT lp.user_id, ev.event_id, {_pri_sql('ev.event_id')} AS priority,
           count(*) OVER (PARTITION BY lp.user_id) AS cnt,
           row_number() OVER (PARTITION BY lp.user_id ORDER BY {_pri_sql('ev.event_id')}, ev.event_id) AS rk
    FROM lp JOIN events ev ON ev.user_id = lp.user_id AND {kind}
     AND (ev.ts < lp.{bound}_ts OR (ev.ts = lp.{bound}_ts AND ev.event_id <= lp.{bound}_id))"""


def _final_sample_sql(kind: str, label: str, k: int) -> str:
    return f"""
    SELECT user_id, '{label}' AS kind, n, CAST({k} AS BIGINT) AS k, sample_rank, priority, value FROM (
      SELECT user_id, event_id AS value, {_pri_sql('event_id')} AS priority,
             count(*) OVER (PARTITION BY user_id) AS n,
             CAST(row_number() OVER (PARTITION BY user_id ORDER BY {_pri_sql('event_id')}, event_id) AS BIGINT)
               AS sample_rank
      FROM events WHERE {kind})
    WHERE sample_rank <= {k}"""


# Final summary per (user, kind) of the element-level paired stream: click stream
# (k1=10) and view stream (k2=15), merged summaries of size m=20.  The last
# merged summary joins the two prefix samples at the user's last J1 pair.
_SP_SQL = f"""
WITH RECURSIVE{_J1_CTES},
 lastpair AS (
   SELECT user_id, out_left, out_right FROM (
     SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rn DESC) AS r FROM sm WHERE out_left IS NOT NULL)
   WHERE r = 1),
 lp AS (
   SELECT p.user_id, el.ts AS l_ts, el.event_id AS l_id, er.ts AS r_ts, er.event_id AS r_id
   FROM lastpair p JOIN events el ON el.event_id = p.out_left JOIN events er ON er.event_id = p.out_right),
 c AS ({_prefix_sample_sql("event_type = 'click'", 10, 'l')}),
 v AS ({_prefix_sample_sql("event_type <> 'click'", 15, 'r')}),
 cs AS (SELECT user_id, max(cnt) AS n1 FROM c GROUP BY user_id),
 vs AS (SELECT user_id, max(cnt) AS n2 FROM v GROUP BY user_id),
 mm AS (SELECT cs.user_id, n1 + n2 AS n,
               least(20, CASE WHEN n1 > 10 THEN 10 END, CASE WHEN n2 > 15 THEN 15 END) AS m_eff
        FROM cs JOIN vs ON cs.user_id = vs.user_id),
 pooled AS (
   SELECT user_id, event_id, priority,
          row_number() OVER (PARTITION BY user_id ORDER BY priority, event_id) AS sample_rank
   FROM (SELECT user_id, event_id, priority FROM c WHERE rk <= 10
         UNION ALL SELECT user_id, event_id, priority FROM v WHERE rk <= 15))
SELECT mm.user_id, 'merged' AS kind, CAST(mm.n AS BIGINT) AS n, CAST(mm.m_eff AS BIGINT) AS k,
       CAST(p.sample_rank AS BIGINT) AS sample_rank, p.priority, p.event_id AS value
FROM mm JOIN pooled p ON p.user_id = mm.user_id AND p.sample_rank <= mm.m_eff
UNION ALL {_final_sample_sql("event_type = 'click'", 'sampled1', 10)}
UNION ALL {_final_sample_sql("event_type <> 'click'", 'sampled2', 15)}
"""


def _paired_changelog(spark, sf_dir) -> str:
    """The paired stream of clicks (k=10) and all other events (k=15), merged
    with m=20: folder of every summary it emitted."""
    from kpool.streaming.changelog import stream_paired_changelog
    from kpool.streaming.sample_stream import run_to_end

    ev = _event_stream(spark, sf_dir)
    query, out = stream_paired_changelog(ev, ["user_id"], F.col("event_type") == "click", "event_id", ["event_id"], ["ts", "event_id"],
                                         k1=10, k2=15, m=20, seed=SEED)
    run_to_end(query)
    return out


@register("stream_paired_merge", _SP_SQL)
def q_stream_paired_merge(spark, sf_dir):
    """Final summary per (user, kind) of the paired stream."""
    from kpool.streaming.changelog import latest

    rows = spark.read.parquet(_paired_changelog(spark, sf_dir))
    return explode_summary(latest(rows, ["user_id", "kind"], "n", "n", "k", "items"), ["user_id", "kind"])


# ------------------------------------------------- S5 S6 X4 T4: stream_outputs
# The paired stream's three kinds as one sink stream with a topic and a label
# per kind, read back: the last message per user and topic.
_TOPICS = {"sampled1": "clicks-sampled", "sampled2": "others-sampled", "merged": "merged"}


@register("stream_outputs", f"""
SELECT user_id, CASE kind WHEN 'sampled1' THEN 'clicks-sampled' WHEN 'sampled2' THEN 'others-sampled' ELSE 'merged' END AS topic,
       kind || ': ' || {_render_sql('max(n)', 'max(k)', 'count(*)', "string_agg(CAST(value AS VARCHAR), ', ' ORDER BY sample_rank)")} AS text
FROM ({_SP_SQL}) GROUP BY user_id, kind
""")
def q_stream_outputs(spark, sf_dir):
    from kpool.session import shared_dir
    from kpool.sources.messages import by_kind, write_summaries
    from kpool.streaming.changelog import latest
    from kpool.streaming.sample_stream import run_to_end

    log = _paired_changelog(spark, sf_dir)
    rows = spark.readStream.schema(spark.read.parquet(log).schema).parquet(log).withColumn("seq", F.col("n"))
    sink = shared_dir(spark, "outputs")
    run_to_end(write_summaries(rows, "parquet", shared_dir(spark, "outputs-ckpt"), {"compression": "zstd"}, path=sink, topic=by_kind(_TOPICS),
                               prefix=by_kind({k: f"{k}: " for k in _TOPICS}), trigger={"availableNow": True}))
    last = latest(spark.read.parquet(sink), ["user_id", "topic"], "seq", "value")
    return last.select("user_id", "topic", F.col("value").cast("string").alias("text"))


# ----------------------------------- T1 element mode, J1 and T2 over several micro-batches
_PARTS = 3  # micro-batches that the events arrive in


def _run_events(spark, sf_dir, start, cols, parts=_PARTS) -> dict[str, str]:
    from kpool.streaming.changelog import run_arrivals

    ev = table(spark, sf_dir, "events").select("event_id", "ts", *cols)
    return run_arrivals(spark, ev, ["ts", "event_id"], parts, start)


def _arriving(spark, sf_dir, start, cols, parts=_PARTS) -> DataFrame:
    return spark.read.parquet(_run_events(spark, sf_dir, start, cols, parts)["out_dir"])


def _events_sql(part: str, extra: str = "") -> str:
    return f"""
    SELECT *, {_pri_sql('event_id')} AS priority, row_number() OVER (PARTITION BY {part} ORDER BY ts, event_id) AS n{extra} FROM events"""


# Per event type: every element that changes the sample, and what it pushes out.
# The SQL counts earlier smaller elements pair by pair.
@register("stream_sample_changelog", f"""
WITH e AS ({_events_sql('event_type')}),
 a AS (SELECT x.event_type, x.n, x.event_id, x.priority FROM e x LEFT JOIN e y
       ON y.event_type = x.event_type AND y.n < x.n AND y.priority <= x.priority
       GROUP BY ALL HAVING count(y.n) < 10),
 full_at AS (SELECT x.event_type, x.n, y.event_id AS gone,
                    row_number() OVER (PARTITION BY x.event_type, x.n ORDER BY y.priority, y.n) AS r
             FROM a x JOIN e y ON y.event_type = x.event_type AND y.n < x.n)
SELECT a.event_type, CAST(a.n AS BIGINT) AS n, a.event_id AS entered, f.gone, f.gone IS NOT NULL AS was_full
FROM a LEFT JOIN full_at f ON f.event_type = a.event_type AND f.n = a.n AND f.r = 10
""")
def q_stream_sample_changelog(spark, sf_dir):
    from kpool.streaming.changelog import stream_changelog

    def start(sdf, **places):
        return stream_changelog(sdf, ["event_type"], 10, "event_id", ["event_id"], ["ts", "event_id"], seed=SEED, **places)

    return _arriving(spark, sf_dir, start, ["event_type"]).drop("batch")


@register("stream_pairs", ORACLE["pair_latest_unmatched"])
def q_stream_pairs(spark, sf_dir):
    """J1 over 7 micro-batches equals the batch query."""
    from kpool.streaming.changelog import stream_pairs

    def start(sdf, **places):
        return stream_pairs(sdf, ["user_id"], F.col("event_type") == "click", ["ts", "event_id"], "event_id", **places)

    return _arriving(spark, sf_dir, start, ["user_id", "event_type"], 7).drop("batch")


# Every summary of the paired stream.  The SQL takes each element's prefix
# samples from scratch, and the pairs from the state machine.
_PC_SQL = f"""
WITH RECURSIVE{_J1_CTES},
 p AS ({_events_sql("user_id, event_type = 'click'", ", CASE WHEN event_type = 'click' THEN 1 ELSE 2 END AS side")}),
 prefix AS (SELECT * FROM (
     SELECT x.user_id, x.side, x.n, x.event_id AS upto, y.event_id, y.priority,
            row_number() OVER (PARTITION BY x.event_id ORDER BY y.priority, y.n) AS r
     FROM p x JOIN p y ON y.user_id = x.user_id AND y.side = x.side AND y.n <= x.n) WHERE r <= CASE side WHEN 1 THEN 10 ELSE 15 END),
 pairs AS (SELECT sm.user_id, l.n AS n1, r.n AS n2, out_left, out_right FROM sm
           JOIN p l ON l.event_id = out_left JOIN p r ON r.event_id = out_right WHERE out_left IS NOT NULL),
 pooled AS (SELECT q.user_id, n1, n2, x.event_id, x.priority,
                   row_number() OVER (PARTITION BY q.user_id, n1, n2 ORDER BY x.priority, x.event_id) AS r,
                   least(20, CASE WHEN n1 > 10 THEN 10 END, CASE WHEN n2 > 15 THEN 15 END) AS m
            FROM pairs q JOIN prefix x ON x.upto = q.out_left OR x.upto = q.out_right)
SELECT user_id, 'sampled' || side AS kind, CASE side WHEN 1 THEN n END AS n1, CASE side WHEN 2 THEN n END AS n2, n,
       CAST(CASE side WHEN 1 THEN 10 ELSE 15 END AS BIGINT) AS k, string_agg(event_id, ',' ORDER BY r) AS items
FROM prefix GROUP BY ALL
UNION ALL
SELECT user_id, 'merged', n1, n2, n1 + n2, CAST(m AS BIGINT), string_agg(event_id, ',' ORDER BY r)
FROM pooled WHERE r <= m GROUP BY ALL
"""


@register("stream_paired_changelog", _PC_SQL)
def q_stream_paired_changelog(spark, sf_dir):
    rows = _paired_rows(spark, sf_dir)
    return rows.select("user_id", "kind", "n1", "n2", "n", "k",
                       F.array_join(F.transform("items", lambda x: x["value"].cast("string")), ",").alias("items"))


def _paired_rows(spark, sf_dir):
    """Clicks (k=10) and all other events (k=15), merged with m=20."""
    from kpool.streaming.changelog import stream_paired_changelog

    def start(sdf, **places):
        return stream_paired_changelog(sdf, ["user_id"], F.col("event_type") == "click", "event_id", ["event_id"], ["ts", "event_id"],
                                       k1=10, k2=15, m=20, seed=SEED, **places)

    return _arriving(spark, sf_dir, start, ["user_id", "event_type"])


# ----------------------------------------------- A4 T5: reservoirs that go on from their state
@register("reservoir_resume", ORACLE["reservoir_by_key"])
def q_reservoir_resume(spark, sf_dir):
    """One reservoir per user, updated by three parts of the events one after another."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    at = ordinal(ev, ["ts", "event_id"], out="at")
    total = at.count()
    pool = seen = None
    for i in range(3):
        part = at.filter((F.col("at") > total * i // 3) & (F.col("at") <= total * (i + 1) // 3)).drop("at")
        pool, seen = reservoir_update(part, 10, ["ts", "event_id"], ["event_id"], ["user_id"], seed=SEED, pool=pool, seen=seen)
        pool, seen = materialize(pool), materialize(seen)
    return pool


@register("stream_reservoir", ORACLE["reservoir_by_key"])
def q_stream_reservoir(spark, sf_dir):
    from kpool.streaming.reservoir_stream import stream_pool, stream_reservoir

    def start(sdf, **places):
        return stream_reservoir(sdf, 10, ["ts", "event_id"], ["event_id"], ["user_id"], seed=SEED, **places)

    places = _run_events(spark, sf_dir, start, ["user_id"])
    return stream_pool(spark, places["table_dir"], ["event_id"], ["user_id"])


@register("stream_reservoir_history", ORACLE["reservoir_history"])
def q_stream_reservoir_history(spark, sf_dir):
    """Intervals closed by later micro-batches, 7 of them."""
    from kpool.streaming.reservoir_stream import stream_history, stream_reservoir

    def start(sdf, **places):
        return stream_reservoir(sdf, _RES_K, ["ts", "event_id"], ["event_id"], seed=SEED, **places)

    places = _run_events(spark, sf_dir, start, [], 7)
    return stream_history(spark, places["table_dir"], places["out_dir"], ["event_id"])


# --------------------------------------------- A12: merge_sides, any number of reservoirs
# Per user: the reservoirs (k=10) of all event types, merged into m=20 items.  The
# SQL walks from side to side and draw to draw in one recursion.
_KT = sql_id_text("user_id")
_ST = sql_id_text("event_type")


def _side_draw(key: str, side: str, i: str, bound: str) -> str:
    return sql_draw(SEED, "side", key, side, i, bound=bound)


@register("merge_sides", f"""
WITH RECURSIVE
 r AS (SELECT user_id, event_type, slot, arg_max(event_id, n) AS event_id, max(n_all) AS n_all FROM (
         SELECT *, CASE WHEN n <= 10 THEN n ELSE 1 + {sql_draw(SEED, 'slot', "''", _KT, _ST, 'n', bound='n')} END AS slot
         FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n,
                      count(*) OVER (PARTITION BY user_id, event_type) AS n_all FROM events))
       WHERE slot <= 10 GROUP BY user_id, event_type, slot),
 s AS (SELECT *, row_number() OVER w AS i, sum(n) OVER (PARTITION BY user_id) AS total,
              sum(n) OVER (PARTITION BY user_id ORDER BY st ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later,
              min(cap) OVER (PARTITION BY user_id) AS kmin
       FROM (SELECT user_id, event_type, {_KT} AS kt, {_ST} AS st, max(n_all) AS n, CASE WHEN max(n_all) > count(*) THEN 10 END AS cap
             FROM r GROUP BY ALL) WINDOW w AS (PARTITION BY user_id ORDER BY st)),
 f(user_id, i, step, m, a, b, c) AS (
   SELECT user_id, i, 0::BIGINT, least(20, kmin, total)::BIGINT, n::BIGINT, coalesce(later, 0)::BIGINT, 0::BIGINT FROM s WHERE i = 1
   UNION ALL
   SELECT g.user_id, g.i + (g.step = g.m)::BIGINT, CASE WHEN g.step = g.m THEN 0 ELSE g.step + 1 END, CASE WHEN g.step = g.m THEN g.m - g.c ELSE g.m END,
          CASE WHEN g.step = g.m THEN t.n::BIGINT WHEN hit THEN g.a - 1 ELSE g.a END,
          CASE WHEN g.step = g.m THEN coalesce(t.later, 0)::BIGINT WHEN hit THEN g.b ELSE g.b - 1 END,
          CASE WHEN g.step = g.m THEN 0 WHEN hit THEN g.c + 1 ELSE g.c END
   FROM (SELECT f.*, CASE WHEN f.step < f.m THEN {_side_draw('o.kt', 'o.st', 'f.step + 1', 'f.a + f.b')} < f.a END AS hit
         FROM f JOIN s o ON o.user_id = f.user_id AND o.i = f.i) g
   LEFT JOIN s t ON t.user_id = g.user_id AND t.i = g.i + 1
   WHERE g.step < g.m OR t.i IS NOT NULL)
SELECT q.user_id, q.event_id, CAST(q.total AS BIGINT) AS n, CAST(least(20, q.kmin, q.total) AS BIGINT) AS k FROM (
  SELECT r.user_id, r.event_id, s.total, s.kmin, s.i,
         row_number() OVER (PARTITION BY r.user_id, r.event_type
           ORDER BY md5(concat_ws(':', '{SEED}', 'perm', s.kt || '|' || s.st, CAST(r.slot - 1 AS VARCHAR)))) AS pos
  FROM r JOIN s ON s.user_id = r.user_id AND s.event_type = r.event_type) q
JOIN f ON f.user_id = q.user_id AND f.i = q.i AND f.step = f.m AND q.pos <= f.c
""")
def q_merge_sides(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    pools = reservoir_summary(ev, ["user_id", "event_type"], 10, ["ts", "event_id"], "event_id", seed=SEED)
    merged = merge_sides(pools, ["user_id"], "event_type", 20, seed=SEED)
    return explode_summary(merged, ["user_id"]).select("user_id", F.col("value").alias("event_id"), "n", "k")


# ------------------------------------------------------------ T4: stream_arrival
# The time at which an element was read stays with it through update and merge:
# ranked, the times of the merged sample's items are their micro-batches.
@register("stream_arrival", f"""
WITH e AS (SELECT event_id, {_pri_sql('event_id')} AS priority, row_number() OVER (ORDER BY ts, event_id) AS n, count(*) OVER () AS total FROM events)
SELECT event_id, CAST(total AS BIGINT) AS n,
       CAST(1 + (n > total // {_PARTS})::INT + (n > total * 2 // {_PARTS})::INT AS BIGINT) AS arrival
FROM e ORDER BY priority LIMIT 60
""")
def q_stream_arrival(spark, sf_dir):
    from kpool.sources.messages import stamp_arrival
    from kpool.streaming.sample_stream import stream_merge, stream_sample

    sides = []

    def start(side, name):
        def run(sdf, table_dir, checkpoint, **_):
            sides.append(f"{table_dir}-{name}")
            return stream_sample(stamp_arrival(sdf).filter(side), [], 60, ["event_id", "arrival_ts"], ["event_id"], seed=SEED,
                                 table_dir=sides[-1], checkpoint=f"{checkpoint}-{name}")
        return run

    def both(sdf, **places):
        from kpool.streaming.sample_stream import run_to_end

        click = F.col("event_type") == "click"
        run_to_end(start(click, "left")(sdf, **places)[0])
        return start(~click, "right")(sdf, **places)

    _run_events(spark, sf_dir, both, ["event_type"])
    merged = explode_summary(stream_merge(spark, sorted(set(sides)), [], 60), []).select("value.event_id", "n", "value.arrival_ts")
    # two streams read a part one after the other: their times are ranked apart
    side = table(spark, sf_dir, "events").select("event_id", (F.col("event_type") == "click").alias("side"))
    by_time = Window.partitionBy("side").orderBy("arrival_ts")
    return merged.join(side, "event_id").select("event_id", "n", F.dense_rank().over(by_time).cast("bigint").alias("arrival"))


# ----------------------------------------------- A3 A6 A8 at large sizes: summary rows
@register("summary_rows_merge", f"""
SELECT o_orderkey AS value, priority, CAST(row_number() OVER (ORDER BY priority, o_orderkey) AS BIGINT) AS sample_rank,
       (SELECT count(*) FROM orders) AS n, CAST(4000 AS BIGINT) AS k
FROM (SELECT o_orderkey, {_pri_sql('o_orderkey')} AS priority FROM orders) ORDER BY priority, o_orderkey LIMIT 4000
""")
def q_summary_rows_merge(spark, sf_dir):
    """Odd and even orders sampled and merged at a size above Spark's group limit,
    as rows: no array holds a pool, no task ranks it whole."""
    from kpool.operators.summary_rows import build_rows, merge_rows

    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    parts = [build_rows(orders.filter(F.col("o_orderkey") % 2 == side), [], 4000, "o_orderkey", ["o_orderkey"], seed=SEED) for side in (0, 1)]
    stats, items = merge_rows(parts, [], 4000)
    row = stats.first()
    return items.select("value", PRIORITY, RANK, F.lit(row["n"]).alias("n"), F.lit(row["k"]).alias("k"))


# ------------------------------------------------------------------ A12: merge_tree
# Events by hour in a stored tree of summaries, appended in three parts; each of ten
# ranges of hours is answered from few nodes.
_TREE_RANGES = 10


@register("merge_tree", f"""
WITH e AS (SELECT event_id, {_pri_sql('event_id')} AS priority, CAST(epoch(ts) AS BIGINT) // 3600 AS hour FROM events),
 b AS (SELECT min(hour) AS lo, max(hour) - min(hour) + 1 AS span FROM e),
 q AS (SELECT i, lo + span * i // {_TREE_RANGES + 3} AS begins, lo + span * (i + 3 + i % 3) // {_TREE_RANGES + 3} + 1 AS ends
       FROM b, (SELECT unnest(range({_TREE_RANGES})) AS i))
SELECT CAST(i AS BIGINT) AS i, n, priority, event_id AS value, CAST(r AS BIGINT) AS sample_rank FROM (
  SELECT i, priority, event_id, count(*) OVER (PARTITION BY i) AS n, row_number() OVER (PARTITION BY i ORDER BY priority, event_id) AS r
  FROM q JOIN e ON hour >= begins AND hour < ends) WHERE r <= 30
""")
def q_merge_tree(spark, sf_dir):
    from kpool.operators.merge_tree import MergeTree
    from kpool.session import shared_dir

    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    ev = ev.withColumn("hour", F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600))
    low, high = ev.agg(F.min("hour"), F.max("hour")).first()
    tree = MergeTree(spark, shared_dir(spark, "tree"), k=30, levels=12)
    for i in range(3):  # parts of the hours, one after another; hours of one part may be appended to later
        tree.append(ev.filter(F.pmod(F.col("event_id"), F.lit(3)) == i), "hour", "event_id", ["event_id"], seed=SEED, append_id=i)
    span = high - low + 1
    steps = _TREE_RANGES + 3
    out = None
    for i in range(_TREE_RANGES):
        found = explode_summary(tree.between(low + span * i // steps, low + span * (i + 3 + i % 3) // steps + 1, 30), [])
        found = found.select(F.lit(i).cast("bigint").alias("i"), "n", PRIORITY, "value", RANK)
        out = found if out is None else out.unionByName(found)
    return out


# --------------------------------------------------------------- A9: default_sizes
# Samples and their merge at the default sizes (k = m = 10) and the default seed.
@register("default_sizes", f"""
SELECT event_type, CAST(total AS BIGINT) AS n, CAST(10 AS BIGINT) AS k, CAST(r AS BIGINT) AS sample_rank, priority, event_id AS value FROM (
  SELECT event_type, event_id, {_pri_sql('event_id', 0)} AS priority, count(*) OVER (PARTITION BY event_type) AS total,
         row_number() OVER (PARTITION BY event_type ORDER BY {_pri_sql('event_id', 0)}, event_id) AS r FROM events) WHERE r <= 10
""")
def q_default_sizes(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("half", parity("event_id"))
    halves = build_summary(ev, ["event_type", "half"], value_cols="event_id", id_cols=["event_id"])
    return explode_summary(merge_summaries(halves, ["event_type"]), ["event_type"])
