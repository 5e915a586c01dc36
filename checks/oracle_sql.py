"""DuckDB oracle SQL, one statement per registered query.

Each statement is written the naive way — one filtered ``GROUP BY`` per
feature, ``lag`` windows for gaps, a pair join for action-to-order gaps —
so it checks the Spark plans by an independent route.
"""

from __future__ import annotations

from . import feature_list as L
from .feature_sql import feature_sql
from .sql_common import (
    ACTION_FACT, ACTIONS, COMMENTS, ENRICHED_ACTIONS, ENRICHED_ORDERS, ORDER_FACT, ORDERS, PAIR_ACTIONS,
    PAIR_ORDERS, SKUS, USERS, d, with_,
)

SQL: dict[str, str] = {}

OW = L.ORDER_WINDOWS
AW = L.ACTION_WINDOWS
W6 = OW[-1]

SQL["a1_target_orders_6m"] = with_(USERS, SKUS, ORDERS, COMMENTS, ORDER_FACT) + f"""
SELECT u.user_id, t.n AS order_count_30_101
FROM users u LEFT JOIN (
  SELECT user_id, CAST(count(DISTINCT o_id) AS BIGINT) AS n FROM ofact
  WHERE o_date BETWEEN {d(W6.begin)} AND {d(W6.end)} AND cate IN (30, 101) GROUP BY user_id) t
ON u.user_id = t.user_id"""

SQL["x2_order_features"] = feature_sql(
    with_(USERS, SKUS, ORDERS, COMMENTS, ORDER_FACT), "ofact", "o_date",
    L.features(L.REFACTORED_ORDERS, OW), OW, {"o_total_price"})

SQL["x2_baseline_order_features"] = feature_sql(
    with_(USERS, SKUS, ORDERS, COMMENTS, ENRICHED_ORDERS), "eorders", "o_date",
    L.features(L.BASELINE_ORDERS, OW), OW, {"total_price"})

SQL["x3_action_features"] = feature_sql(
    with_(USERS, SKUS, ACTIONS, ACTION_FACT), "afact", "a_date",
    L.features(L.REFACTORED_ACTIONS, AW), AW, set())

SQL["x3_baseline_action_features"] = feature_sql(
    with_(USERS, SKUS, ACTIONS, ENRICHED_ACTIONS), "eactions", "a_date",
    L.features(L.BASELINE_ACTIONS, AW), AW, set())


def _pair_sql(strict: bool, by_cate: bool, name) -> str:
    cte_pa = ("pa AS (SELECT a.user_id, a.sku_id, c.cate, a.a_date FROM pactions a "
              "LEFT JOIN (SELECT DISTINCT sku_id, cate FROM skus) c ON a.sku_id = c.sku_id)")
    cte_po = ("po AS (SELECT o.user_id, o.sku_id, coalesce(c.cate, -1) AS cate, o.o_date FROM porders o "
              "LEFT JOIN (SELECT DISTINCT sku_id, cate FROM skus) c ON o.sku_id = c.sku_id)")
    on = "pa.user_id = po.user_id AND pa.sku_id = po.sku_id" + (" AND pa.cate = po.cate" if by_cate else "")
    cmp = ">" if strict else ">="
    cte_pairs = (f"pr AS (SELECT pa.user_id, pa.a_date, po.o_date, date_diff('day', pa.a_date, po.o_date) AS g "
                 f"FROM pa JOIN po ON {on} WHERE po.o_date {cmp} pa.a_date)")
    sel, joins = ["u.user_id"], []
    for i, w in enumerate(OW):
        cond = f"a_date BETWEEN {d(w.begin)} AND {d(w.end)} AND o_date BETWEEN {d(w.begin)} AND {d(w.end)}"
        joins.append(f"LEFT JOIN (SELECT user_id, round(CAST(avg(g) AS DOUBLE), 6) AS v FROM pr WHERE {cond} "
                     f"GROUP BY user_id) w{i} ON u.user_id = w{i}.user_id")
        sel.append(f"w{i}.v AS \"{name(w.label)}\"")
    return (with_(USERS, SKUS, PAIR_ACTIONS, PAIR_ORDERS, cte_pa, cte_po, cte_pairs)
            + "SELECT " + ", ".join(sel) + " FROM users u " + " ".join(joins))


SQL["x4_action_order_features"] = _pair_sql(False, True, lambda k: f"{k}mo_action_order_all_date_gap")
SQL["x4_baseline_action_order_gap"] = _pair_sql(True, False, lambda k: f"GM{k}_action2order_diff")

LB, LE = L.LABEL_BEGIN, L.LABEL_END
_IN_LABEL = f"o_date BETWEEN {d(LB)} AND {d(LE)}"

SQL["x6_labels"] = with_(USERS, SKUS, ORDERS, COMMENTS, ORDER_FACT) + f"""
, lab AS (SELECT user_id, count(DISTINCT o_id) AS n, min(date_diff('day', {d(LB)}, o_date)) AS pd
          FROM ofact WHERE {_IN_LABEL} AND cate IN (30, 101) GROUP BY user_id)
SELECT u.user_id, CAST(coalesce(lab.n, 0) AS BIGINT) AS order_num, CAST(coalesce(lab.pd, 0) AS BIGINT) AS pred_date,
       lab.n IS NOT NULL AS has_order
FROM users u LEFT JOIN lab ON u.user_id = lab.user_id"""

SQL["x6_baseline_labels"] = with_(USERS, SKUS, ORDERS, COMMENTS, ENRICHED_ORDERS) + f"""
, lab AS (SELECT user_id, count(DISTINCT o_id) AS n, min(date_diff('day', {d(LB)}, o_date)) AS pd
          FROM eorders WHERE {_IN_LABEL} AND cate IN (30, 101) GROUP BY user_id)
SELECT u.user_id, u.age, u.sex, u.user_lv_cd, CAST(coalesce(lab.n, 0) AS BIGINT) AS Label_30_101_BuyNum,
       CAST(coalesce(lab.pd, 0) AS BIGINT) AS Label_30_101_FirstTime
FROM users u LEFT JOIN lab ON u.user_id = lab.user_id"""

SQL["a42_inference_labels"] = with_(USERS) + """
SELECT user_id, age, sex, user_lv_cd, CAST(-1 AS BIGINT) AS Label_30_101_BuyNum, CAST(-1 AS BIGINT) AS Label_30_101_FirstTime
FROM users"""

SQL["a43_ground_truth"] = with_(ORDERS) + f"""
SELECT user_id, min(o_date) AS order_date FROM orders_r WHERE {_IN_LABEL} GROUP BY user_id"""


def _label_month(b, e):
    return (f"SELECT user_id, CAST(count(DISTINCT o_id) AS BIGINT) AS order_num, "
            f"CAST(min(date_diff('day', {d(b)}, o_date)) AS BIGINT) AS pred_date, {d(b)} AS cutoff "
            f"FROM ofact WHERE o_date BETWEEN {d(b)} AND {d(e)} AND cate IN (30, 101) GROUP BY user_id")


from datetime import date as _date  # noqa: E402

SQL["u1_stacked_periods"] = with_(USERS, SKUS, ORDERS, COMMENTS, ORDER_FACT) + "\nUNION ALL\n".join([
    _label_month(_date(2000, 12, 1), _date(2000, 12, 31)),
    _label_month(_date(2001, 1, 1), _date(2001, 1, 31)),
    _label_month(_date(2001, 2, 1), _date(2001, 2, 28)),
])

SQL["f10_sku_bands"] = with_(SKUS) + """
, e AS (SELECT quantile_cont(CAST(price AS DOUBLE), [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS pe,
               quantile_cont(CAST(para_1 AS DOUBLE), [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS p1 FROM skus)
SELECT s.sku_id,
  CASE WHEN s.price IS NULL THEN NULL WHEN s.price <= e.pe[2] THEN 0 WHEN s.price <= e.pe[3] THEN 1
       WHEN s.price <= e.pe[4] THEN 2 WHEN s.price <= e.pe[5] THEN 3 ELSE 4 END AS price,
  CASE WHEN s.cate = 30 THEN 1 WHEN s.cate = 101 THEN 2 ELSE 0 END AS cate,
  CASE WHEN s.para_1 IS NULL THEN NULL WHEN s.para_1 <= e.p1[2] THEN 0 WHEN s.para_1 <= e.p1[3] THEN 1
       WHEN s.para_1 <= e.p1[4] THEN 2 WHEN s.para_1 <= e.p1[5] THEN 3 ELSE 4 END AS para_1,
  s.para_2, s.para_3
FROM skus s, e"""

# The prototype's order table by plain pair expansion (m order lines x n scored lines per user, sku, day).
PROTO_ORDERS = """pj AS (
  SELECT od.user_id, od.sku_id, od.o_date, coalesce(sd.score_level, -1) AS score_level
  FROM orders_r od LEFT JOIN (
    SELECT o.user_id, o.sku_id, o.o_date, c.score_level FROM orders_r o
    JOIN comments c ON o.o_id = c.o_id AND o.user_id = c.user_id WHERE c.score_level IS NOT NULL) sd
  ON od.user_id = sd.user_id AND od.sku_id = sd.sku_id AND od.o_date = sd.o_date)"""

SQL["j6_prototype_order_scores"] = with_(ORDERS, COMMENTS, PROTO_ORDERS) + """
SELECT user_id, sku_id, o_date, CAST(score_level AS INTEGER) AS score_level, CAST(count(*) AS BIGINT) AS weight
FROM pj GROUP BY user_id, sku_id, o_date, score_level"""

PSKU = "psku AS (SELECT sku_id, CASE WHEN cate = 30 THEN 1 WHEN cate = 101 THEN 2 ELSE 0 END AS cc FROM skus)"
PG = {"30": "cc = 1", "101": "cc = 2", "tg": "cc <> 0", "ntg": "cc = 0"}
FB, FE_ = L.PROTO_FEATURE


def _proto_feature_ctes():
    av = ", ".join(f"sum(CASE WHEN {PG[g]} AND a_type = 1 THEN a_num END) AS view_num_{g}, "
                   f"sum(CASE WHEN {PG[g]} AND a_type = 2 THEN a_num END) AS star_num_{g}" for g in L.PROTO_GROUPS)
    ov = ", ".join(f"count(CASE WHEN {PG[g]} THEN 1 END) AS order_num_{g}, "
                   f"count(CASE WHEN {PG[g]} AND score_level = 1 THEN 1 END) AS good_score_num_{g}, "
                   f"count(CASE WHEN {PG[g]} AND score_level = 3 THEN 1 END) AS bad_score_num_{g}"
                   for g in L.PROTO_GROUPS)
    anyg = " OR ".join(f"({PG[g]})" for g in L.PROTO_GROUPS)
    af = (f"af AS (SELECT a.user_id, {av} FROM actions a JOIN psku p ON a.sku_id = p.sku_id "
          f"WHERE a.a_date BETWEEN {d(FB)} AND {d(FE_)} AND a.a_type IN (1, 2) AND ({anyg}) GROUP BY a.user_id)")
    of = (f"ofe AS (SELECT o.user_id, {ov} FROM pj o JOIN psku p ON o.sku_id = p.sku_id "
          f"WHERE o.o_date BETWEEN {d(FB)} AND {d(FE_)} AND ({anyg}) GROUP BY o.user_id)")
    return af, of


_AF, _OF = _proto_feature_ctes()
_PF_COLS = ([f"{k}_num_{g}" for g in L.PROTO_GROUPS for k in ("view", "star")]
            + [f"{k}_{g}" for g in L.PROTO_GROUPS for k in ("order_num", "good_score_num", "bad_score_num")])

SQL["x7_prototype_features"] = with_(USERS, SKUS, ORDERS, COMMENTS, ACTIONS, PROTO_ORDERS, PSKU, _AF, _OF) + \
    "SELECT coalesce(af.user_id, ofe.user_id) AS user_id, " + \
    ", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in _PF_COLS) + \
    " FROM af FULL OUTER JOIN ofe ON af.user_id = ofe.user_id"

_lab_cols = ", ".join(
    f"min(CASE WHEN {PG[g]} THEN date_diff('day', {d(LB)}, o.o_date) END) AS pred_date_{g}, "
    f"nullif(count(CASE WHEN {PG[g]} THEN 1 END), 0) AS order_num_{g}" for g in L.PROTO_GROUPS)
_anyg = " OR ".join(f"({PG[g]})" for g in L.PROTO_GROUPS)
PLAB = (f"plab AS (SELECT o.user_id, {_lab_cols} FROM pj o JOIN psku p ON o.sku_id = p.sku_id "
        f"WHERE o.o_date BETWEEN {d(LB)} AND {d(LE)} AND ({_anyg}) GROUP BY o.user_id)")
FUSERS = "fu AS (SELECT user_id FROM af UNION SELECT user_id FROM ofe)"
_PL_COLS = [f"{k}_{g}" for g in L.PROTO_GROUPS for k in ("pred_date", "order_num")]
PROTO_LABELS = ("plabels AS (SELECT fu.user_id, " + ", ".join(f"CAST(coalesce(plab.{c}, -1) AS BIGINT) AS {c}" for c in _PL_COLS)
                + " FROM fu LEFT JOIN plab ON fu.user_id = plab.user_id)")
_PROTO_BASE = (USERS, SKUS, ORDERS, COMMENTS, ACTIONS, PROTO_ORDERS, PSKU, _AF, _OF, PLAB, FUSERS, PROTO_LABELS)

SQL["x7_prototype_labels"] = with_(*_PROTO_BASE) + "SELECT * FROM plabels"
SQL["u2_align_users"] = SQL["x7_prototype_labels"]

_MID = "DATE '2001-02-14'"
_valid = {g: f"(pred_date_{g} >= 0.5 AND order_num_{g} >= 0.5)" for g in L.PROTO_GROUPS}
_day = "least(" + ", ".join(f"CASE WHEN {_valid[g]} THEN pred_date_{g} END" for g in L.PROTO_GROUPS) + ")"
_num = " + ".join(f"coalesce(CASE WHEN {_valid[g]} THEN order_num_{g} END, 0)" for g in L.PROTO_GROUPS)
SQL["x9_submission_prototype"] = with_(*_PROTO_BASE) + f"""
, m AS (SELECT user_id, {_day} AS dd, {_num} AS sc FROM plabels)
, r AS (SELECT user_id, dd, row_number() OVER (ORDER BY sc DESC, user_id) AS rank FROM m WHERE dd IS NOT NULL)
SELECT user_id, least(CAST({d(LB)} + CAST(floor(dd) AS INTEGER) AS DATE), {_MID}) AS pred_date, rank
FROM r WHERE rank <= {L.TOP_N}"""

_PRED = (f"pred AS (SELECT user_id, count(DISTINCT o_id) AS n, min(o_day) AS pd FROM ofact "
         f"WHERE o_date BETWEEN {d(W6.begin)} AND {d(W6.end)} AND cate IN (30, 101) GROUP BY user_id)")
_RANKED = "ranked AS (SELECT user_id, n, pd, row_number() OVER (ORDER BY n DESC, user_id) AS rank FROM pred)"

SQL["k1_top_users"] = with_(USERS, SKUS, ORDERS, COMMENTS, ORDER_FACT, _PRED, _RANKED) + f"""
SELECT user_id, CAST(n AS BIGINT) AS order_num, rank FROM ranked WHERE rank <= {L.TOP_N}"""

_SUB_REF = (f"sub AS (SELECT user_id, CAST({d(LB)} + CAST(floor(pd) AS INTEGER) AS DATE) AS pred_date, rank "
            f"FROM ranked WHERE rank <= {L.TOP_N})")
SQL["x9_submission_refactored"] = with_(USERS, SKUS, ORDERS, COMMENTS, ORDER_FACT, _PRED, _RANKED, _SUB_REF) + \
    "SELECT * FROM sub"

_TRUTH = f"truth AS (SELECT user_id, min(o_date) AS order_date FROM orders_r WHERE {_IN_LABEL} GROUP BY user_id)"
SQL["x10_score"] = with_(USERS, SKUS, ORDERS, COMMENTS, ORDER_FACT, _PRED, _RANKED, _SUB_REF, _TRUTH) + """
, s1 AS (SELECT sum(CASE WHEN t.user_id IS NOT NULL THEN 1.0 / (1 + ln(s.rank)) ELSE 0 END) / sum(1.0 / (1 + ln(s.rank))) AS v
         FROM sub s LEFT JOIN truth t ON s.user_id = t.user_id)
, s2 AS (SELECT coalesce(sum(10.0 / (10 + power(date_diff('day', t.order_date, s.pred_date), 2))), 0)
                / (SELECT count(*) FROM truth) AS v FROM truth t JOIN sub s ON s.user_id = t.user_id)
SELECT round(CAST(s1.v AS DOUBLE), 6) AS s1, round(CAST(s2.v AS DOUBLE), 6) AS s2,
       round(CAST(0.4 * s1.v + 0.6 * s2.v AS DOUBLE), 6) AS s FROM s1, s2"""


def _gapvar(k_label, w):
    lag = (f"SELECT user_id, o_date, date_diff('day', lag(o_date) OVER (PARTITION BY user_id ORDER BY o_date), o_date) AS g "
           f"FROM eorders WHERE o_date BETWEEN {d(w.begin)} AND {d(w.end)} AND cate IN (30, 101)")
    return (f"g{k_label} AS (SELECT user_id, CASE WHEN count(DISTINCT o_date) > 2 THEN stddev_samp(g) END AS v "
            f"FROM ({lag}) GROUP BY user_id)")


_GV = [_gapvar(w.label, w) for w in OW]
_W = ("coalesce(exp(-g1.v / 4.9), 0) / 2 + coalesce(exp(-g3.v / 12.5), 0) / 3 + coalesce(exp(-g6.v / 21.2), 0) / 6")
_GJ = " ".join(f"LEFT JOIN g{k} ON u.user_id = g{k}.user_id" for k in ("1", "3", "6"))
SQL["x8_regularity_weight"] = with_(USERS, SKUS, ORDERS, COMMENTS, ENRICHED_ORDERS, *_GV) + f"""
SELECT u.user_id, round(CAST({_W} AS DOUBLE), 6) AS weight FROM users u {_GJ}"""

_BP = (f"bp AS (SELECT user_id, CASE WHEN count(CASE WHEN cate IN (30, 101) THEN 1 END) > 0 "
       f"THEN count(DISTINCT CASE WHEN cate IN (30, 101) THEN o_id END) END AS cnt6, "
       f"min(CASE WHEN cate IN (30, 101) THEN day END) AS first6 FROM eorders "
       f"WHERE o_date BETWEEN {d(W6.begin)} AND {d(W6.end)} GROUP BY user_id)")
SQL["x9_submission_baseline"] = with_(USERS, SKUS, ORDERS, COMMENTS, ENRICHED_ORDERS, *_GV, _BP) + f"""
, sc AS (SELECT u.user_id, u.cnt6 * ({_W}) AS score, u.first6 FROM bp u {_GJ})
, r AS (SELECT user_id, first6, row_number() OVER (ORDER BY score DESC NULLS LAST, user_id) AS rank FROM sc)
SELECT user_id, least(CAST({d(LB)} + CAST(trunc(first6 + 0.49 - 1) AS INTEGER) AS DATE), DATE '2001-02-14') AS pred_date, rank
FROM r WHERE rank <= {L.TOP_N}"""

EDGES = """e AS (SELECT o.o_custkey AS src, l.l_partkey AS dst FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""
DEG = """deg AS (SELECT id, sum(o) AS out_deg, sum(i) AS in_deg FROM (
  SELECT src AS id, 1 AS o, 0 AS i FROM e UNION ALL SELECT dst AS id, 0 AS o, 1 AS i FROM e) GROUP BY id)"""


def _pagerank_sql(iters: int, places: int = 10) -> str:
    ctes = [EDGES,
            "links AS (SELECT src, dst, count(*) AS cnt FROM e WHERE src <> dst GROUP BY src, dst)",
            "od AS (SELECT src, sum(cnt) AS deg FROM links GROUP BY src)",
            "nodes AS (SELECT n.id, od.deg FROM (SELECT src AS id FROM e UNION SELECT dst FROM e) n "
            "LEFT JOIN od ON n.id = od.src)",
            "nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM nodes)",
            "r0 AS MATERIALIZED (SELECT id, deg, 1.0 / (SELECT n FROM nn) AS rank FROM nodes)"]
    for i in range(1, iters + 1):
        prev = f"r{i - 1}"
        ctes.append(
            f"r{i} AS MATERIALIZED (SELECT r.id, r.deg, 0.85 * (coalesce(c.s, 0) + "
            f"(SELECT coalesce(sum(rank), 0) FROM {prev} WHERE deg IS NULL) / (SELECT n FROM nn)) "
            f"+ 0.15 / (SELECT n FROM nn) AS rank FROM {prev} r LEFT JOIN ("
            f"SELECT l.dst, sum(p.rank / p.deg * l.cnt) AS s FROM links l JOIN {prev} p ON l.src = p.id "
            f"GROUP BY l.dst) c ON r.id = c.dst)")
    return with_(*ctes) + f"SELECT id, round(rank, {places}) AS rank FROM r{iters}"


SQL["x14_pagerank"] = _pagerank_sql(L.PAGERANK_UPDATES)
# Converged ranks: 60 updates leave less than 0.85 ** 60 of the first error, and 6 places are compared.
_CONVERGED = _pagerank_sql(60, 17)
SQL["x14_pagerank_converged"] = f"SELECT id, round(rank, 6) AS rank FROM ({_CONVERGED})"
SQL["k2_top100_ranks"] = ("SELECT id, round(rank, 6) AS rank, row_number() OVER (ORDER BY rank DESC, id) AS pos FROM ("
                          + _CONVERGED + ") ORDER BY pos LIMIT 100")
SQL["x15_rank_of"] = f"SELECT id, round(rank, 6) AS rank FROM ({_CONVERGED}) WHERE id = {L.RANK_NODE}"

SQL["a44_graph_counts"] = with_(EDGES) + """
SELECT CAST(count(*) AS BIGINT) AS n_edges,
       CAST((SELECT count(DISTINCT src) FROM e) AS BIGINT) AS n_sources,
       CAST((SELECT count(DISTINCT dst) FROM e) AS BIGINT) AS n_targets,
       CAST((SELECT count(*) FROM (SELECT src FROM e UNION SELECT dst FROM e)) AS BIGINT) AS n_nodes,
       CAST((SELECT count(*) FROM (SELECT src FROM e UNION SELECT dst FROM e EXCEPT SELECT src FROM e)) AS BIGINT) AS n_dead_ends,
       CAST((SELECT count(*) FROM (SELECT src FROM e UNION SELECT dst FROM e EXCEPT SELECT dst FROM e)) AS BIGINT) AS n_dead_starts
FROM e"""

SQL["a45_degrees"] = with_(EDGES) + """
SELECT n.id, CAST(coalesce(o.c, 0) AS BIGINT) AS out_deg, CAST(coalesce(i.c, 0) AS BIGINT) AS in_deg
FROM (SELECT src AS id FROM e UNION SELECT dst FROM e) n
LEFT JOIN (SELECT src, count(*) AS c FROM e GROUP BY src) o ON n.id = o.src
LEFT JOIN (SELECT dst, count(*) AS c FROM e GROUP BY dst) i ON n.id = i.dst"""

_DESC = """SELECT '{k}' AS kind, CAST(count(*) AS BIGINT) AS count, round(avg(c), 6) AS mean,
  round(stddev_samp(c), 6) AS std, CAST(min(c) AS BIGINT) AS min, round(quantile_cont(c, 0.25), 6) AS p25,
  round(quantile_cont(c, 0.5), 6) AS p50, round(quantile_cont(c, 0.75), 6) AS p75, CAST(max(c) AS BIGINT) AS max
FROM (SELECT {col}, CAST(count(*) AS DOUBLE) AS c FROM e GROUP BY {col})"""
SQL["a46_degree_summary"] = with_(EDGES) + _DESC.format(k="out", col="src") + "\nUNION ALL\n" + _DESC.format(k="in", col="dst")

SQL["a47_degree_histogram"] = with_(EDGES) + """
SELECT 'out' AS kind, CAST(c AS BIGINT) AS bucket, CAST(count(*) AS BIGINT) AS n
FROM (SELECT src, count(*) AS c FROM e GROUP BY src) WHERE c < 40 GROUP BY c
UNION ALL
SELECT 'in' AS kind, CAST(c AS BIGINT) AS bucket, CAST(count(*) AS BIGINT) AS n
FROM (SELECT dst, count(*) AS c FROM e GROUP BY dst) WHERE c < 200 GROUP BY c"""

SQL["a47_degree_histogram_full"] = with_(EDGES) + """
SELECT 'out' AS kind, CAST(c AS BIGINT) AS bucket, CAST(count(*) AS BIGINT) AS n
FROM (SELECT src, count(*) AS c FROM e GROUP BY src) GROUP BY c
UNION ALL
SELECT 'in' AS kind, CAST(c AS BIGINT) AS bucket, CAST(count(*) AS BIGINT) AS n
FROM (SELECT dst, count(*) AS c FROM e GROUP BY dst) GROUP BY c"""


def _melt(sql: str, section: str, kind: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{section}' AS section, {kind} AS kind, '{c}' AS key, CAST({c} AS DOUBLE) AS value FROM ({sql})" for c in cols)


SQL["x16_graph_profile"] = "\nUNION ALL\n".join([
    _melt(SQL["a44_graph_counts"], "counts", "'all'", ["n_edges", "n_sources", "n_targets", "n_nodes", "n_dead_ends", "n_dead_starts"]),
    _melt(SQL["a46_degree_summary"], "summary", "kind", ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]),
    "SELECT 'histogram' AS section, kind, CAST(bucket AS VARCHAR) AS key, CAST(n AS DOUBLE) AS value FROM ("
    + SQL["a47_degree_histogram_full"] + ")"])

SQL["u3_all_nodes"] = with_(EDGES) + "SELECT src AS id FROM e UNION SELECT dst FROM e"
SQL["u4_dead_ends"] = with_(EDGES) + "SELECT src AS id FROM e UNION SELECT dst FROM e EXCEPT SELECT src FROM e"
SQL["u5_dead_starts"] = with_(EDGES) + "SELECT src AS id FROM e UNION SELECT dst FROM e EXCEPT SELECT dst FROM e"

SQL["s8_users"] = with_(USERS) + "SELECT * FROM users"
SQL["s8_skus"] = with_(SKUS) + "SELECT * FROM skus"
SQL["s8_orders"] = with_(ORDERS) + "SELECT * FROM orders_r"
SQL["s8_comments"] = with_(COMMENTS) + "SELECT * FROM comments"
SQL["s8_actions"] = with_(ACTIONS) + "SELECT * FROM actions"
SQL["j1_enrich_orders"] = with_(USERS, SKUS, ORDERS, COMMENTS, ENRICHED_ORDERS) + "SELECT * FROM eorders"
SQL["j2_enrich_actions"] = with_(USERS, SKUS, ACTIONS, ENRICHED_ACTIONS) + "SELECT * FROM eactions"
SQL["j3_j5_order_fact"] = with_(SKUS, ORDERS, COMMENTS, ORDER_FACT) + "SELECT * FROM ofact"
SQL["j3_action_fact"] = with_(SKUS, ACTIONS, ACTION_FACT) + "SELECT * FROM afact"

SQL["w1_successive_gaps"] = with_(SKUS, ORDERS, COMMENTS, ORDER_FACT) + f"""
, r AS (SELECT user_id, o_date, date_diff('day', lag(o_date) OVER (PARTITION BY user_id ORDER BY o_date), o_date) AS g
        FROM ofact WHERE o_date BETWEEN {d(W6.begin)} AND {d(W6.end)} AND cate IN (30, 101))
SELECT user_id, o_date, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(CASE WHEN o_date = min(min(o_date)) OVER (PARTITION BY user_id) THEN NULL ELSE max(g) END AS BIGINT) AS gap
FROM r GROUP BY user_id, o_date"""

_F2 = []
for _w in OW:
    for _g in ("30", "101", "30_101", "others", "all"):
        from .feature_sql import PRED_SQL as _P  # noqa: E402
        _F2.append(f"SELECT '{_w.label}' AS window, '{_g}' AS grp, CAST(count(*) AS BIGINT) AS n_lines, "
                   f"CAST(count(DISTINCT user_id) AS BIGINT) AS n_users FROM ofact "
                   f"WHERE o_date BETWEEN {d(_w.begin)} AND {d(_w.end)} AND {_P[_g]} HAVING count(*) > 0")
SQL["f2_group_line_counts"] = with_(SKUS, ORDERS, COMMENTS, ORDER_FACT) + "\nUNION ALL\n".join(_F2)

SQL["c_scalar_functions"] = with_(ORDERS) + f"""
SELECT user_id, o_id, sku_id, CAST(year(o_date) AS INTEGER) AS year, CAST(month(o_date) AS INTEGER) AS month,
  CAST(day(o_date) AS INTEGER) AS day, CAST(date_diff('day', {d(LB)}, o_date) AS INTEGER) AS offset,
  CAST({d(LB)} + CAST(trunc(o_sku_num / 7.0 + 0.49 - 1) AS INTEGER) AS DATE) AS date_trunc,
  CAST({d(LB)} + CAST(floor(o_sku_num / 7.0) AS INTEGER) AS DATE) AS date_floor,
  least(o_date, {d(L.BASELINE_CAP)}) AS date_capped,
  round(coalesce(exp(-(CASE WHEN o_area > 2 THEN o_sku_num END) / 12.5), 0), 8) AS decay,
  round(1.0 / (1 + ln(o_sku_num + 1)), 8) AS weight,
  round(10.0 / (10 + power(date_diff('day', {d(LB)}, o_date) - 14, 2)), 8) AS closeness,
  abs(o_sku_num - 25.0) <= 1.0 + 0.2 * abs(25.0) AS close,
  CAST(trunc(o_sku_num / 4.0) AS INTEGER) AS quarter_trunc
FROM orders_r WHERE o_date BETWEEN {d(LB)} AND {d(LE)}"""

SQL["x5_build_features"] = (with_(USERS) + "SELECT * FROM users u "
                            + f"JOIN ({SQL['x3_action_features']}) a USING (user_id) "
                            + f"JOIN ({SQL['x2_order_features']}) o USING (user_id) "
                            + f"JOIN ({SQL['x4_action_order_features']}) ao USING (user_id)")
SQL["x5_baseline_features"] = (f"SELECT * FROM ({SQL['x6_baseline_labels']}) l "
                               + f"JOIN ({SQL['x2_baseline_order_features']}) o USING (user_id) "
                               + f"JOIN ({SQL['x3_baseline_action_features']}) a USING (user_id) "
                               + f"JOIN ({SQL['x4_baseline_action_order_gap']}) g USING (user_id)")

# Every column of X5 but the id, with -999 for NULL, and whether it was NULL.
SQL["m3_prepare_matrix"] = (f"WITH x AS ({SQL['x5_build_features']}), y AS (SELECT * EXCLUDE (user_id) FROM x) "
                            "SELECT x.user_id, v.*, m.* FROM (SELECT user_id, row_number() OVER () AS r FROM x) x "
                            "POSITIONAL JOIN (SELECT coalesce(CAST(COLUMNS(*) AS DOUBLE), -999.0) FROM y) v "
                            "POSITIONAL JOIN (SELECT CAST(COLUMNS('(.*)') IS NULL AS INTEGER) AS '\\1_missing' FROM y) m")

# Folds: dealt out in turn in the order of md5('2018:user').
SQL["w4_folds"] = f"""SELECT *,
  CAST((row_number() OVER (ORDER BY md5('2018:' || user_id), user_id) - 1) % 5 AS INTEGER) AS fold,
  CAST((row_number() OVER (PARTITION BY has_order ORDER BY md5('2018:' || user_id), user_id) - 1) % 5 AS INTEGER) AS strat_fold
FROM ({SQL["x6_labels"]})"""

# Sources and sinks as round trips.
SQL["s1_retail_csv"] = with_(USERS, SKUS, ORDERS, COMMENTS, ACTIONS) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS tbl, count(*) AS n_rows, CAST(sum({k}) AS BIGINT) AS keys, CAST(sum({n}) AS BIGINT) AS numbers, "
    f"CAST({f'sum(date_diff($$day$$, DATE $$1970-01-01$$, CAST({day} AS DATE)))' if day else '0'} AS BIGINT) AS days FROM {src}"
    for t, src, k, n, day in (("user", "users", "user_id", "age", None), ("sku", "skus", "sku_id", "cate", None),
                              ("action", "actions", "user_id", "a_num", "a_date"),
                              ("comment", "comments", "o_id", "score_level", "comment_create_tm"),
                              ("order", "orders_r", "o_id", "o_sku_num", "o_date")))
SQL["s2_rejected_rows"] = with_(ORDERS) + """SELECT reason, count(*) AS n FROM (SELECT CASE o_id % 50 WHEN 1 THEN 'o_date is no date'
  WHEN 2 THEN 'wrong number of fields' WHEN 3 THEN 'o_sku_num is no int' ELSE '' END AS reason FROM orders_r) GROUP BY reason"""
SQL["s3_edges_tsv"] = with_(EDGES) + "SELECT src, dst FROM e"
SQL["s4_submission_file"] = f"SELECT user_id, pred_date, rank AS place FROM ({SQL['x9_submission_refactored']})"
SQL["s6_rank_vector"] = SQL["x14_pagerank"]
SQL["s7_top_rank_lines"] = f"SELECT id, round(rank, 6) AS rank FROM ({_pagerank_sql(L.PAGERANK_UPDATES, 17)}) ORDER BY rank DESC, id LIMIT 100"

# Flows and models: who is listed or predicted, and in which range.
_LISTED = f"SELECT least({L.SUBMISSION_SIZE}, count(*)) AS listed, least({L.SUBMISSION_SIZE}, count(*)) AS known, least({L.SUBMISSION_SIZE}, count(*)) AS users, true AS in_time FROM customer"
SQL["p_baseline_flow"] = SQL["p_refactored_flow"] = _LISTED
SQL["p0_prototype_flow"] = "SELECT true AS short, true AS known, true AS once, true AS in_time"
SQL["x11_prediction_range"] = "SELECT c_custkey AS user_id, true AS order_num_in_range, true AS pred_date_in_range FROM customer"
SQL["x13_label_range"] = f"SELECT user_id, true AS days_in_range, true AS counts_in_range FROM ({SQL['x7_prototype_features']})"
SQL["x17_score_range"] = "SELECT true AS s1_in_range, true AS s2_in_range, true AS s_in_range, true AS blend"
SQL["x18_feature_list"] = (f"SELECT model, column_name AS name, true AS gain_where_used FROM (DESCRIBE {SQL['x5_build_features']}) "
                           "CROSS JOIN (VALUES ('order_num'), ('pred_date')) m(model) WHERE column_name <> 'user_id'")
