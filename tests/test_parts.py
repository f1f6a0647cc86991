"""Parts that follow the number of rows, not their bytes."""

import re

from marquee.starschema import queries


def test_neighbours_are_checked_in_parts_that_follow_the_titles(spark, tmp_path, monkeypatch):
    orders = spark.range(1, 61).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "1e5D AS o_totalprice", "timestamp'1995-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority"
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines = orders.selectExpr("o_orderkey AS l_orderkey", "5.0D AS l_quantity", "0.05D AS l_discount")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(queries, "TITLES_OF_A_TASK", 4)
    found = queries.QUERIES["similar_titles_check"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    parts = [int(n) for n in re.findall(r"hashpartitioning\(tconst#\d+, (\d+)\), REPARTITION_BY_NUM", plan)]
    titles = found.count()
    assert titles > 40 and parts and min(parts) >= titles / 4
    assert found.where("itself > 0 OR NOT in_order OR neighbours <> 10").count() == 0
