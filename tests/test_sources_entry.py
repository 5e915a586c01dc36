"""Sources, sinks, window arithmetic and the driver contract."""

import os
import tempfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shoprank.plans.windows import feature_windows
from shoprank.sources import edges as E
from shoprank.sources import retail, sinks


def test_feature_windows():
    w = feature_windows(date(2017, 5, 1))
    assert w.label_end == date(2017, 5, 31) and w.feature_end == date(2017, 4, 30)
    assert [x.begin for x in w.features] == [date(2017, 4, 1), date(2017, 2, 1), date(2016, 11, 1)]


def test_read_retail_csv_selects_by_name(spark):
    d = tempfile.mkdtemp(prefix="shoprank-csv-")
    files = {
        "sku": "cate,sku_id,price,para_1,para_2,para_3\n30,1,9.5,1,2,3\n",
        "action": "a_date,user_id,sku_id,a_num,a_type\n2017-03-01,7,1,2,1\n",
        "user": "user_id,age,sex,user_lv_cd\n7,3,1,2\n",
        "comment": "user_id,comment_create_tm,o_id,score_level\n7,2017-03-02 10:11:12,5,1\n",
        "order": "user_id,sku_id,o_id,o_date,o_area,o_sku_num\n7,1,5,2017-03-01,4,2\n",
    }
    for k, text in files.items():
        with open(os.path.join(d, retail.RETAIL_FILES[k]), "w") as f:
            f.write(text)
    b = retail.read_retail_csv(spark, d)
    s = b.sku.first()
    assert s["sku_id"] == 1 and s["cate"] == 30 and s["price"] == 9.5
    assert b.action.first()["a_date"] == date(2017, 3, 1)
    assert b.comment.first()["comment_create_tm"] == datetime(2017, 3, 2, 10, 11, 12)
    assert b.order.schema["o_date"].dataType.typeName() == "date"


def test_csv_rows_that_do_not_parse_are_set_aside(spark):
    d = tempfile.mkdtemp(prefix="shoprank-csv-")
    good = {
        "sku": "cate,sku_id,price,para_1,para_2,para_3\n30,1,9.5,1,2,3\n",
        "action": "a_date,user_id,sku_id,a_num,a_type\n2017-03-01,7,1,2,1\n",
        "user": "user_id,age,sex,user_lv_cd\n7,,1,2\n",
        "comment": "user_id,comment_create_tm,o_id,score_level\n7,2017-03-02 10:11:12,5,1\n",
    }
    for k, text in good.items():
        with open(os.path.join(d, "x_" + retail.RETAIL_FILES[k]), "w") as f:
            f.write(text)
    with open(os.path.join(d, "mine.csv"), "w") as f:
        f.write("user_id,sku_id,o_id,o_date,o_area,o_sku_num\n7,1,5,2017-03-01,4,2\n7,1,6,2017-02-30,4,2\n7,1,7\n7,1,8,2017-03-01,4,2,9\n"
                "seven,1,9,2017-03-01,4,2\n7,,10, 2017-03-04 ,,1\n")
    got = retail.load_retail_csv(spark, d, "x_", {"order": "mine.csv"})
    assert got.counts == {"sku": (1, 0), "action": (1, 0), "user": (1, 0), "comment": (1, 0), "order": (2, 4)}
    assert [tuple(r) for r in got.bundle.order.orderBy("o_id").collect()] == [
        (7, 1, 5, date(2017, 3, 1), 4, 2), (7, None, 10, date(2017, 3, 4), None, 1)]
    assert got.bundle.user.first()["age"] is None
    rejected = {(r["line"], r["reason"]) for r in got.rejected.collect()}
    assert rejected == {("7,1,6,2017-02-30,4,2", "o_date is no date"), ("7,1,7", "wrong number of fields"),
                        ("7,1,8,2017-03-01,4,2,9", "wrong number of fields"), ("seven,1,9,2017-03-01,4,2", "user_id is no bigint")}
    assert {r["file"] for r in got.rejected.collect()} == {os.path.join(d, "mine.csv")}
    with pytest.raises(ValueError, match="do not parse"):
        retail.read_retail_csv(spark, d, "x_", {"order": "mine.csv"})


def test_a_long_list_is_written_in_order_by_many_tasks(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="shoprank-sub-"), "sub")
    ids = spark.range(1_000_000).select((F.col("id") * 7 % 1_000_003).alias("user_id"), F.lit(date(2017, 5, 2)).alias("pred_date"),
                                        (F.col("id") + 1).alias("rank")).repartition(16, "user_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_submission(ids, out)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted(fn for fn in os.listdir(out) if fn.startswith("part-"))
    lines = "".join(open(os.path.join(out, fn)).read() for fn in parts).splitlines()
    assert len(parts) > 4 and lines[0] == "user_id,pred_date"
    assert lines[1:] == [f"{i * 7 % 1_000_003},2017-05-02" for i in range(1_000_000)]


def test_edges_tsv_and_rank_sinks(spark):
    d = tempfile.mkdtemp(prefix="shoprank-edges-")
    p = os.path.join(d, "edges.tsv")
    with open(p, "w") as f:
        f.write("1\t2\n2\t3\n3\t1\n")
    e = E.read_edges_tsv(spark, p)
    assert e.count() == 3 and e.schema["src"].dataType.typeName() == "long"
    from shoprank.operators import graph
    r = graph.pagerank(e)
    sinks.write_ranks(r, os.path.join(d, "ranks"))
    back = sinks.read_ranks(spark, os.path.join(d, "ranks"))
    assert back.count() == 3
    sinks.write_top_ranks(back, os.path.join(d, "top"), n=2)
    lines = [ln for fn in os.listdir(os.path.join(d, "top")) if fn.endswith(".csv")
             for ln in open(os.path.join(d, "top", fn)).read().splitlines()]
    assert len(lines) == 2 and "\t" in lines[0]


def test_submission_sink_and_name(spark):
    d = tempfile.mkdtemp(prefix="shoprank-sub-")
    pred = spark.createDataFrame([(5, date(2017, 5, 2), 2), (3, date(2017, 5, 1), 1)],
                                 "user_id long, pred_date date, rank long")
    out = os.path.join(d, "sub")
    sinks.write_submission(pred, out)
    text = "".join(open(os.path.join(out, fn)).read() for fn in sorted(os.listdir(out)) if fn.endswith(".txt"))
    assert text.splitlines() == ["user_id,pred_date", "3,2017-05-01", "5,2017-05-02"]
    assert sinks.timestamped_name("prediction", datetime(2017, 5, 1, 9, 7)) == "prediction_0501_0907.csv"


def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and "user_id" in df.columns
    qs = entry.queries()
    sql = entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 45
