"""Shared SQL fragments for the DuckDB oracle: the retail adapter as CTEs.

These restate, in plain SQL, the mapping of ``FIXTURES.md`` §3 from the
synthetic tables to the retail tables, independently of the Spark code.
"""

from __future__ import annotations

from datetime import date

USERS = """users AS (
  SELECT c_custkey AS user_id, c_nationkey AS age,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2
                           WHEN 'HOUSEHOLD' THEN 3 WHEN 'MACHINERY' THEN 4 END AS sex,
         CAST(floor(c_acctbal / 1000) AS INTEGER) AS user_lv_cd
  FROM customer)"""

SKUS = """skus AS (
  SELECT p_partkey AS sku_id, p_retailprice AS price,
         CASE p_type WHEN 'PROMO' THEN 30 WHEN 'LARGE' THEN 101 WHEN 'ECONOMY' THEN 71
                     WHEN 'MEDIUM' THEN 46 WHEN 'SMALL' THEN 83 END AS cate,
         p_size AS para_1, CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS para_2, -1 AS para_3
  FROM part)"""

ORDERS = """orders_r AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS sku_id, l.l_orderkey AS o_id,
         CAST(o.o_orderdate AS DATE) AS o_date, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS o_area,
         CAST(floor(l.l_quantity) AS INTEGER) AS o_sku_num
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

COMMENTS = """comments AS (
  SELECT o_custkey AS user_id, o_orderdate + INTERVAL 7 DAY AS comment_create_tm, o_orderkey AS o_id,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 3 END AS score_level
  FROM orders WHERE o_orderstatus IN ('F', 'O'))"""

ACTIONS = """actions AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS sku_id, CAST(ts AS DATE) AS a_date,
         CAST(1 + floor(value / 100) AS INTEGER) AS a_num,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS a_type
  FROM events)"""

# Refactored-pipeline facts (category, score default -1, price, date parts).
ORDER_FACT = """ofact AS (
  SELECT o.user_id, o.sku_id, o.o_id, o.o_date, o.o_area, o.o_sku_num, c.cate,
         CAST(coalesce(s.score_level, -1) AS INTEGER) AS score_level,
         CAST(month(o.o_date) AS INTEGER) AS o_month, CAST(day(o.o_date) AS INTEGER) AS o_day, p.price * o.o_sku_num AS o_total_price
  FROM orders_r o
  LEFT JOIN (SELECT DISTINCT sku_id, cate FROM skus) c ON o.sku_id = c.sku_id
  LEFT JOIN comments s ON o.o_id = s.o_id AND o.user_id = s.user_id
  LEFT JOIN (SELECT DISTINCT sku_id, price FROM skus) p ON o.sku_id = p.sku_id)"""

ACTION_FACT = """afact AS (
  SELECT a.user_id, a.sku_id, a.a_date, a.a_num, a.a_type, c.cate, CAST(month(a.a_date) AS INTEGER) AS a_month, CAST(day(a.a_date) AS INTEGER) AS a_day
  FROM actions a LEFT JOIN (SELECT DISTINCT sku_id, cate FROM skus) c ON a.sku_id = c.sku_id)"""

# Baseline enriched facts.
ENRICHED_ORDERS = """eorders AS (
  SELECT o.user_id, o.sku_id, o.o_id, o.o_date, o.o_area, o.o_sku_num, c.comment_create_tm, c.score_level,
         u.age, u.sex, u.user_lv_cd, s.price, s.cate, s.para_1, s.para_2, s.para_3,
         s.price * o.o_sku_num AS total_price,
         CAST(year(o.o_date) AS INTEGER) AS year, CAST(month(o.o_date) AS INTEGER) AS month, CAST(day(o.o_date) AS INTEGER) AS day
  FROM orders_r o
  LEFT JOIN comments c ON o.user_id = c.user_id AND o.o_id = c.o_id
  LEFT JOIN users u ON o.user_id = u.user_id
  LEFT JOIN skus s ON o.sku_id = s.sku_id)"""

ENRICHED_ACTIONS = """eactions AS (
  SELECT a.user_id, a.sku_id, a.a_date, a.a_num, a.a_type, u.age, u.sex, u.user_lv_cd,
         s.price, s.cate, s.para_1, s.para_2, s.para_3,
         CAST(year(a.a_date) AS INTEGER) AS year, CAST(month(a.a_date) AS INTEGER) AS month, CAST(day(a.a_date) AS INTEGER) AS day
  FROM actions a LEFT JOIN users u ON a.user_id = u.user_id LEFT JOIN skus s ON a.sku_id = s.sku_id)"""

# Action/order pair sources: the same order lines, action date = order date, order date = ship date.
PAIR_ACTIONS = """pactions AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS sku_id, CAST(o.o_orderdate AS DATE) AS a_date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

PAIR_ORDERS = """porders AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS sku_id, l.l_orderkey AS o_id, CAST(l.l_shipdate AS DATE) AS o_date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def d(x: date) -> str:
    return f"DATE '{x.isoformat()}'"
