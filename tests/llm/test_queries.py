"""The registered queries against their SQL in DuckDB, and plans that must stay free of Python."""

import duckdb
import pytest

from shoprank.llm.oracle import SQL
from shoprank.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in "documents embeddings pages conversations".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.sql(SQL[name])
    cols = sorted(rel.columns)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == cols
    want = sorted(map(str, rel.select(", ".join(cols)).fetchall()))
    rows = sorted(map(str, map(tuple, got.select(cols).collect())))
    assert rows and rows == want


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if k not in SQL and k != "pipeline"))
def test_other_queries_give_a_row_per_input_row(spark, name):
    df = QUERIES[name](spark, SF)
    n = {"op7_html_text": "pages"}.get(name, "documents")
    if name == "op8_packed_ids":
        assert {d for r in df.collect() for d in r["doc_ids"]} == {r[0] for r in spark.read.parquet(f"{SF}/{n}.parquet").select("doc_id").collect()}
    else:
        assert df.count() == spark.read.parquet(f"{SF}/{n}.parquet").count()


def test_line_dedup_runs_no_python(spark):
    plan = QUERIES["op4_line_dedup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan
