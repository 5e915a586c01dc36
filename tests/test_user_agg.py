"""Unit rows for the windowed per-user aggregation engine (FIXTURES §2)."""

from datetime import date

from pyspark.sql import functions as F

from shoprank.operators import features
from shoprank.operators.user_agg import Agg, user_window_agg
from shoprank.plans.windows import Win

W1 = Win("1", date(2001, 1, 1), date(2001, 1, 31))
W3 = Win("3", date(2000, 11, 1), date(2001, 1, 31))
SCHEMA = "user_id long, o_id long, sku_id long, o_date date, cate int, o_day int, o_month int, price double"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _run(df, specs, wins=(W1, W3)):
    preds = features.group_predicates()
    return {r["user_id"]: r.asDict() for r in user_window_agg(df, specs, wins, preds, "o_date").collect()}


def test_unknown_category_in_others_and_all(spark):
    df = _rows(spark, [(1, 10, 5, date(2001, 1, 5), None, 5, 1, 1.0)])
    out = _run(df, [Agg("t", "nunique", "o_id", "30_101", "1"), Agg("o", "nunique", "o_id", "others", "1"),
                    Agg("a", "nunique", "o_id", "all", "1")])
    assert out[1]["t"] is None and out[1]["o"] == 1 and out[1]["a"] == 1


def test_absent_group_is_null_and_null_price_sums_to_zero(spark):
    df = _rows(spark, [(1, 10, 5, date(2001, 1, 5), 71, 5, 1, None), (2, 11, 6, date(2001, 1, 5), 30, 5, 1, None)])
    out = _run(df, [Agg("n", "nunique", "o_id", "30_101", "1"), Agg("c", "count", "sku_id", "30_101", "1"),
                    Agg("s", "sum", "price", "30_101", "1")])
    assert out[1] == {"user_id": 1, "n": None, "c": None, "s": None}
    assert out[2]["n"] == 1 and out[2]["c"] == 1 and out[2]["s"] == 0.0


def test_multi_line_order(spark):
    df = _rows(spark, [(1, 10, s, date(2001, 1, 5), 30, 5, 1, 1.0) for s in (1, 2, 3)])
    out = _run(df, [Agg("n", "nunique", "o_id", "all", "1"), Agg("c", "count", "sku_id", "all", "1")])
    assert out[1]["n"] == 1 and out[1]["c"] == 3


def test_gap_mean_and_deviation(spark):
    df = _rows(spark, [(1, i, 1, date(2001, 1, dd), 30, dd, 1, 1.0) for i, dd in enumerate((1, 2, 8))])
    out = _run(df, [Agg("m", "gap_mean", "o_date", "30_101", "1"), Agg("s", "gap_std", "o_date", "30_101", "1")])
    assert out[1]["m"] == 3
    assert abs(out[1]["s"] - 3.5355339) < 1e-6


def test_gap_one_row_and_gate(spark):
    one = _rows(spark, [(1, 1, 1, date(2001, 1, 3), 30, 3, 1, 1.0)])
    out = _run(one, [Agg("m", "gap_mean", "o_date", "30_101", "1"), Agg("s", "gap_std", "o_date", "30_101", "1")])
    assert out[1]["m"] is None and out[1]["s"] is None
    two = _rows(spark, [(1, i, 1, date(2001, 1, dd), 30, dd, 1, 1.0) for i, dd in enumerate((3, 3, 8))])
    out = _run(two, [Agg("s", "gap_std", "o_date", "30_101", "1")])
    assert out[1]["s"] is None


def test_gap_deviation_with_repeated_days(spark):
    # gaps 0, 1, 2 -> sample std 1
    df = _rows(spark, [(1, i, 1, date(2001, 1, dd), 30, dd, 1, 1.0) for i, dd in enumerate((4, 4, 5, 7))])
    out = _run(df, [Agg("s", "gap_std", "o_date", "30_101", "1")])
    assert abs(out[1]["s"] - 1.0) < 1e-9


def test_gap_across_window_edge(spark):
    days = [date(2000, 12, 20), date(2001, 1, 2), date(2001, 1, 10), date(2001, 1, 30)]
    df = _rows(spark, [(1, i, 1, x, 30, x.day, x.month, 1.0) for i, x in enumerate(days)])
    out = _run(df, [Agg("s1", "gap_std", "o_date", "30_101", "1"), Agg("s3", "gap_std", "o_date", "30_101", "3")])
    import statistics
    assert abs(out[1]["s1"] - statistics.stdev([8, 20])) < 1e-9
    assert abs(out[1]["s3"] - statistics.stdev([13, 8, 20])) < 1e-9


def test_mode_tie_takes_lowest(spark):
    df = _rows(spark, [(1, i, 1, date(2001, 1, dd), 30, dd, 1, 1.0) for i, dd in enumerate((3, 1, 1, 3))])
    out = _run(df, [Agg("m", "mode", "o_day", "30_101", "1")])
    assert out[1]["m"] == 1


def test_month_number_wrap_and_window_edges(spark):
    df = _rows(spark, [(1, 1, 1, date(2000, 12, 5), 30, 5, 12, 1.0), (1, 2, 1, date(2001, 1, 31), 30, 31, 1, 1.0),
                       (1, 3, 1, date(2000, 11, 1), 30, 1, 11, 1.0)])
    out = _run(df, [Agg("last", "max", "o_month", "30_101", "3"), Agg("n", "nunique", "o_month", "30_101", "3"),
                    Agg("rows", "rows", None, "30_101", "3")])
    assert out[1]["last"] == 12 and out[1]["n"] == 3 and out[1]["rows"] == 3


def test_nested_counts_are_monotone(spark):
    of = features.refactored_order_features
    from shoprank.plans import catalog as C
    from shoprank.operators import enrich
    from shoprank.sources import retail
    b = retail.retail_from_testdata(spark, "/root/testdata/sf0.01")
    f = of(enrich.order_fact(b), C.ORDER_WINDOWS.features)
    bad = f.where((F.coalesce(F.col("1mo_order_all_num"), F.lit(0)) > F.coalesce(F.col("3mo_order_all_num"), F.lit(0)))
                  | (F.coalesce(F.col("3mo_order_all_num"), F.lit(0)) > F.col("6mo_order_all_num"))).count()
    assert bad == 0
    # an order may hold both categories: 30 + 101 >= 30_101
    bad = f.where(F.coalesce(F.col("6mo_order_30_num"), F.lit(0)) + F.coalesce(F.col("6mo_order_101_num"), F.lit(0))
                  < F.coalesce(F.col("6mo_order_30_101_num"), F.lit(0))).count()
    assert bad == 0
