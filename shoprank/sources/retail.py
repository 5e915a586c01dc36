"""Retail sources: the five headered CSV files (S1, S2) and the adapter that
derives the same five tables from the synthetic parquet tables (S8)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schema import (
    ACTION_SCHEMA,
    COMMENT_SCHEMA,
    ORDER_SCHEMA,
    SKU_SCHEMA,
    USER_SCHEMA,
    RetailBundle,
)
from ..session import read_back, shared_path

# Base names of the five retail tables' CSV files (a common
# prefix, if the files carry one, is passed to ``read_retail_csv``).
RETAIL_FILES = {
    "sku": "sku_basic_info.csv",
    "action": "user_action.csv",
    "user": "user_basic_info.csv",
    "comment": "user_comment_score.csv",
    "order": "user_order.csv",
}

_SCHEMAS = {
    "sku": SKU_SCHEMA,
    "action": ACTION_SCHEMA,
    "user": USER_SCHEMA,
    "comment": COMMENT_SCHEMA,
    "order": ORDER_SCHEMA,
}


def _typed(name: str, field) -> Column:
    """A text column as its declared type; NULL where it does not parse (S2 date parsing)."""
    kind = {"date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP_NTZ"}.get(field.dataType.typeName(), field.dataType.simpleString())
    return F.expr(f"try_cast(trim(`{name}`) AS {kind})")


@dataclass
class RetailCsv:
    """The typed tables of five CSV files, the rows that do not parse and the counts of both."""

    bundle: RetailBundle
    rejected: DataFrame  # file, line (as read), reason
    counts: dict[str, tuple[int, int]]  # table -> good rows, rejected rows


def _checked(spark: SparkSession, path: str, schema) -> DataFrame:
    """The declared columns typed, with the line as read and the first reason against it (NULL if none).

    Column order is not fixed: the header names the columns. A row is refused
    when it has more or fewer fields than the header, or a value that is not
    of its column's type; an empty field is a missing value.
    """
    header = spark.read.option("header", True).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    text = ", ".join(f"`{c}` STRING" for c in header)
    raw = spark.read.schema(f"{text}, `_line` STRING").option("header", True).option("enforceSchema", True).option(
        "mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").csv(path)
    typed = [_typed(f.name, f).alias(f.name) for f in schema.fields]
    bad = [F.when(F.col("_line").isNotNull(), F.lit("wrong number of fields"))]
    bad += [F.when(F.col(f"`{f.name}`").isNotNull() & _typed(f.name, f).isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
            for f in schema.fields]
    line = F.coalesce("_line", F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in header]))
    return raw.select(*typed, line.alias("_line"), F.coalesce(*bad).alias("_reason"))


def load_retail_csv(spark: SparkSession, directory: str, prefix: str = "", files: dict[str, str] | None = None,
                    path: str | None = None) -> RetailCsv:
    """S1 + S2: the five headered CSV files, with bad rows set aside instead of failing the job or turning into NULLs.

    Files are named ``<prefix><base name>`` or by ``files`` (table to file
    name or full path). Each file is read and parsed once: its rows are
    written to ``path`` (a place in the checkpoint folder by default), good
    and rejected ones apart, and counted in that same pass.
    """
    path = path or shared_path(spark, "retail-csv")
    frames, rejected, counts = {}, [], {}
    for key, base in RETAIL_FILES.items():
        name = (files or {}).get(key, f"{prefix}{base}")
        source = name if "/" in name else f"{directory.rstrip('/')}/{name}"
        seen = Observation(f"csv_{key}_{uuid.uuid4().hex}")
        rows = _checked(spark, source, _SCHEMAS[key]).withColumn("_bad", F.col("_reason").isNotNull())
        rows = rows.observe(seen, F.count(F.when(~F.col("_bad"), 1)).alias("good"), F.count(F.when(F.col("_bad"), 1)).alias("bad"))
        rows.write.partitionBy("_bad").parquet(f"{path}/{key}")
        counts[key] = (seen.get["good"], seen.get["bad"])
        table = spark.read.schema(rows.schema).parquet(f"{path}/{key}")
        frames[key] = table.where(~F.col("_bad")).select(*[f.name for f in _SCHEMAS[key].fields])
        rejected.append(table.where("_bad").select(F.lit(source).alias("file"), F.col("_line").alias("line"), F.col("_reason").alias("reason")))
    return RetailCsv(RetailBundle(**frames), reduce(DataFrame.unionByName, rejected), counts)


def read_retail_csv(spark: SparkSession, directory: str, prefix: str = "", files: dict[str, str] | None = None) -> RetailBundle:
    """S1 + S2: the five typed tables; a row that does not parse is an error (see ``load_retail_csv`` to set such rows aside)."""
    loaded = load_retail_csv(spark, directory, prefix, files)
    bad = {k: n for k, (_, n) in loaded.counts.items() if n}
    if bad:
        raise ValueError(f"rows that do not parse: {bad}; first: {loaded.rejected.first().asDict()}")
    return loaded.bundle


def write_retail_csv(b: RetailBundle, directory: str, prefix: str = "") -> None:
    """The five tables as headered CSV files (folders of parts), as ``read_retail_csv`` takes them."""
    for key, base in RETAIL_FILES.items():
        getattr(b, key).write.option("header", True).csv(f"{directory.rstrip('/')}/{prefix}{base}")


# Fixed values of the adapter from the synthetic tables.
SEGMENT_CODES = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2, "HOUSEHOLD": 3, "MACHINERY": 4}
TYPE_CATES = {"PROMO": 30, "LARGE": 101, "ECONOMY": 71, "MEDIUM": 46, "SMALL": 83}  # STANDARD -> NULL
EVENT_TYPES = {"view": 1, "click": 2}  # every other event type -> 3
COMMENT_SCORES = {"F": 1, "O": 3}  # status P has no comment
COMMENT_DELAY_DAYS = 7


def _case(col, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


# Declared schemas of the synthetic tables read here (no footer-based inference).
TESTDATA_SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TESTDATA_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def users_from_testdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("long").alias("user_id"),
        F.col("c_nationkey").cast("int").alias("age"),
        _case(F.col("c_mktsegment"), SEGMENT_CODES).cast("int").alias("sex"),
        F.floor(F.col("c_acctbal") / 1000).cast("int").alias("user_lv_cd"),
    )


def skus_from_testdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("long").alias("sku_id"),
        F.col("p_retailprice").cast("double").alias("price"),
        _case(F.col("p_type"), TYPE_CATES).cast("int").alias("cate"),
        F.col("p_size").cast("int").alias("para_1"),
        F.regexp_extract(F.col("p_brand"), r"(\d+)", 1).cast("int").alias("para_2"),
        F.lit(-1).cast("int").alias("para_3"),
    )


def order_lines_from_testdata(spark: SparkSession, sf_dir: str, begin: date | None = None, end: date | None = None,
                              shipped: bool = False, path: str | None = None) -> DataFrame:
    """Order lines with both dates and the order's status: one read of each of the two tables.

    With ``begin`` and ``end`` only lines ordered in that time (the filter
    reaches the scan of the orders) or, with ``shipped``, ordered or shipped
    in it. With ``path`` they are written there once, for all that is built
    on them.
    """
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    lines = li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.col("o_custkey").cast("long").alias("user_id"),
        F.col("l_partkey").cast("long").alias("sku_id"),
        F.col("l_orderkey").cast("long").alias("o_id"),
        F.to_date(F.col("o_orderdate")).alias("o_date"),
        F.substring(F.col("o_orderpriority"), 1, 1).cast("int").alias("o_area"),
        F.floor(F.col("l_quantity")).cast("int").alias("o_sku_num"),
        F.to_date(F.col("l_shipdate")).alias("ship_date"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_tm"),
        F.col("o_orderstatus").alias("status"),
    )
    if begin:
        lines = lines_within(lines, begin, end, shipped)
    return read_back(lines, path) if path else lines


def lines_within(lines: DataFrame, begin: date, end: date, shipped: bool = False) -> DataFrame:
    """The order lines ordered (with ``shipped``: ordered or shipped) in a time."""
    within = [F.col(c).between(F.lit(begin), F.lit(end)) for c in (["o_date", "ship_date"] if shipped else ["o_date"])]
    return lines.where(within[0] | within[-1])


def orders_from_lines(lines: DataFrame) -> DataFrame:
    return lines.select("user_id", "sku_id", "o_id", "o_date", "o_area", "o_sku_num")


def orders_from_testdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_from_lines(order_lines_from_testdata(spark, sf_dir))


def _comment(user: Column, order: Column, tm: Column, status: Column) -> list[Column]:
    return [user.cast("long").alias("user_id"),
            (tm.cast("timestamp_ntz") + F.expr(f"INTERVAL {COMMENT_DELAY_DAYS} DAYS")).alias("comment_create_tm"),
            order.cast("long").alias("o_id"), _case(status, COMMENT_SCORES).cast("int").alias("score_level")]


def comments_from_testdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    return o.where(F.col("o_orderstatus").isin(*COMMENT_SCORES)).select(
        *_comment(F.col("o_custkey"), F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderstatus")))


def comments_from_lines(lines: DataFrame) -> DataFrame:
    """The comments of the orders that have lines, one per order."""
    orders = lines.where(F.col("status").isin(*COMMENT_SCORES)).select("user_id", "o_id", "order_tm", "status").distinct()
    return orders.select(*_comment(F.col("user_id"), F.col("o_id"), F.col("order_tm"), F.col("status")))


def actions_from_testdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("long").alias("user_id"),
        F.get_json_object(F.col("props"), "$.k").cast("long").alias("sku_id"),
        F.to_date(F.col("ts")).alias("a_date"),
        (F.lit(1) + F.floor(F.col("value") / 100)).cast("int").alias("a_num"),
        _case(F.col("event_type"), EVENT_TYPES, 3).cast("int").alias("a_type"),
    )


def retail_from_testdata(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> RetailBundle:
    """The five retail tables derived from the synthetic parquet tables.

    With ``lines`` orders and comments come from these order lines instead of
    a read of their own.
    """
    return RetailBundle(
        user=users_from_testdata(spark, sf_dir),
        sku=skus_from_testdata(spark, sf_dir),
        action=actions_from_testdata(spark, sf_dir),
        order=orders_from_testdata(spark, sf_dir) if lines is None else orders_from_lines(lines),
        comment=comments_from_testdata(spark, sf_dir) if lines is None else comments_from_lines(lines),
    )


def pair_sources_from_testdata(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Action and order sides for the action-to-order gap.

    Both come from the same order lines: the action date is the order date and
    the order date is the ship date, so every line pairs with itself.
    """
    j = order_lines_from_testdata(spark, sf_dir) if lines is None else lines
    action = j.select("user_id", "sku_id", F.col("o_date").alias("a_date"), F.lit(1).alias("a_num"), F.lit(1).alias("a_type"))
    order = j.select("user_id", "sku_id", "o_id", F.col("ship_date").alias("o_date"), "o_area", "o_sku_num")
    return action, order
