import math
from inspect import signature

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from marquee.functions.columns import cosine, weighted_mean
from marquee.operators import neighbours
from marquee.operators.distribution import box_plot, correlation_matrix, histogram
from marquee.operators.ids import dense_ids
from marquee.operators.neighbours import nearest_items
from marquee.operators.skew import frequent_keys, spread_join
from marquee.plans import crew


def hot_table(spark, size, name):
    """A third of the rows under one key, the rest under many."""
    return spark.range(size).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("key"),
        F.col("id").alias(name),
    )


def test_frequent_keys_finds_the_hot_one(spark):
    assert rows(frequent_keys(hot_table(spark, 30_000, "a"), "key", 0.1)) == [("hot",)]
    numbers = spark.range(50_000).selectExpr("if(id % 4 = 0, 7L, id) AS key")
    assert rows(frequent_keys(numbers, "key")) == [(7,)]
    assert frequent_keys(numbers.where("key < 0"), "key").count() == 0


def test_every_frequent_key_is_found(spark):
    """Many keys just above the share, among far more that are rare."""
    frame = spark.range(200_000).selectExpr("if(id % 2 = 0, id % 300, id) AS key")
    counts = frame.groupBy("key").count().where("count >= 200")
    assert sorted(rows(frequent_keys(frame, "key"))) == sorted(rows(counts, "key"))


def test_spread_join_of_nothing(spark):
    left = spark.createDataFrame([], "key string, a int")
    right = spark.createDataFrame([("x", 5)], "key string, b int")
    assert rows(spread_join(left, right, "key", ["a"])) == []


@pytest.mark.parametrize("both", [False, True])
def test_spread_join_equals_plain_join(spark, both):
    left, right = hot_table(spark, 3000, "a"), hot_table(spark, 300, "b")
    spread = spread_join(left, right, "key", ["a"], ["b"] if both else [], ways=7)
    plain = left.join(right, "key")
    assert spread.columns == ["key", "a", "b"]
    assert spread.count() == plain.count()
    assert spread.exceptAll(plain).count() == 0


def test_spread_join_deals_a_hot_key_to_many_tasks(spark):
    left = hot_table(spark, 30_000, "a")
    one = spark.createDataFrame([("hot", 1)], "key string, x int")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spread_join(left, one, "key", ["a"], ways=64)
        tasks = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    assert sum(r["count"] for r in tasks) == 10_000
    assert max(r["count"] for r in tasks) < 4000


def test_spread_join_drops_null_keys(spark):
    left = spark.createDataFrame([(None, 1), ("x", 2)], "key string, a int")
    right = spark.createDataFrame([(None, 1), ("x", 5)], "key string, b int")
    assert rows(spread_join(left, right, "key", ["a"])) == [("x", 2, 5)]


def test_network_with_a_hot_title(spark):
    people = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("t"), F.col("id") % 40)).alias("tconst"),
        F.concat(F.lit("n"), F.col("id") % 60).alias("nconst"),
        F.when(F.col("id") % 2 == 0, "director").otherwise("producer").alias("category"),
    )
    got = {tuple(r)[:2]: r[2] for r in crew.collaboration_network(people, ways=9).collect()}
    local = people.collect()
    want = {}
    for d in local:
        for p in local:
            if d.tconst == p.tconst and d.category == "director" and p.category == "producer":
                want[d.nconst, p.nconst] = want.get((d.nconst, p.nconst), 0) + 1
    assert got == want


def test_histogram(spark):
    values = spark.createDataFrame([(0.0,), (0.0,), (5.0,), (10.0,), (None,)], "v double")
    got = {r.bin: r for r in histogram(values, "v").collect()}
    assert {b: r.num_titles for b, r in got.items() if r.num_titles} == {0: 2, 10: 1, 19: 1}
    assert len(got) == 20
    assert (got[0].bin_start, got[19].bin_end) == (0.0, 10.0)


def test_histogram_of_one_value(spark):
    values = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    want, edges = np.histogram([3.0, 3.0], bins=20)
    got = histogram(values, "v").collect()
    assert [r.num_titles for r in got] == list(want)
    assert got[0].bin_start == edges[0]


def test_histogram_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "v double")
    got = histogram(empty, "v").collect()
    assert [r.num_titles for r in got] == [0] * 20 and got[0].bin_start is None


def test_box_plot(spark):
    values = spark.createDataFrame([("x", float(v)) for v in (1, 2, 3, 4, 100)], "k string, v double")
    assert rows(box_plot(values, "k", "v")) == [("x", 2.0, 3.0, 4.0, 1.0, 4.0, 5, 1)]


def test_box_plot_counts_repeats(spark):
    numbers = [1.0] * 5 + [2.0] * 3 + [7.0] * 2 + [50.0]
    values = spark.createDataFrame([("x", v) for v in numbers], "k string, v double")
    got = box_plot(values, "k", "v").first()
    assert [got.q1, got["median"], got.q3] == list(np.percentile(numbers, [25, 50, 75]))
    assert (got.n, got.n_outliers) == (11, 1)


def test_correlation(spark):
    line = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0), (None, 9.0, 5.0)], "x double, y double, c double")
    got = {(r.var_x, r.var_y): r.corr for r in correlation_matrix(line, ["x", "y", "c"]).collect()}
    assert got["x", "y"] == pytest.approx(1.0)
    assert got["x", "c"] is None and got["c", "c"] is None


def test_cosine(spark):
    vectors = spark.createDataFrame(
        [([1.0, 0.0], [0.0, 1.0]), ([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>"
    )
    got = [r[0] for r in vectors.select(cosine(F.col("a"), F.col("b"))).collect()]
    assert got[:2] == [0.0, pytest.approx(math.sqrt(0.5))] and got[2] is None


def test_weighted_mean_skips_nulls(spark):
    frame = spark.createDataFrame([(2.0, 3), (None, 5), (6.0, 1)], "v double, n long")
    assert frame.agg(weighted_mean(F.col("v"), F.col("n"))).first()[0] == 3.0


def test_dense_ids(spark):
    keys = spark.range(1000).selectExpr("concat('k', id % 250) AS key")
    got = dense_ids(keys, "key", "number").collect()
    assert sorted(r.number for r in got) == list(range(250))
    assert got and {r.key: r.number for r in got} == {
        r.key: r.number for r in dense_ids(keys.repartition(3), "key", "number").collect()
    }


def brute_force(items, count):
    best = {}
    for name, vector in items:
        scored = []
        for other, towards in items:
            if other != name and np.linalg.norm(vector) and np.linalg.norm(towards):
                value = np.dot(vector, towards) / np.linalg.norm(vector) / np.linalg.norm(towards)
                scored.append((-round(value, 9), other))
        best[name] = [other for _, other in sorted(scored)[:count]]
    return best


@pytest.mark.parametrize("block_rows", [1000, 17])
def test_nearest_items_equals_brute_force(spark, block_rows):
    random = np.random.default_rng(5)
    kinds = random.integers(-3, 4, size=(12, 4)).astype(float)
    # A third of the items share one vector, others repeat often, one is zero.
    items = [(f"i{n:03d}", kinds[0] if n % 3 == 0 else kinds[n % 12]) for n in range(90)]
    items += [(f"r{n:02d}", random.normal(size=4)) for n in range(20)] + [("zero", np.zeros(4))]
    frame = spark.createDataFrame([(n, [float(x) for x in v]) for n, v in items], "id string, v array<double>")
    want = brute_force(items, 5)
    got = {}
    for row in nearest_items(frame, "id", "v", 5, block_rows).orderBy("id", "rank").collect():
        got.setdefault(row.id, []).append(row.neighbour)
    assert got == {name: best for name, best in want.items() if best}


def test_nearest_items_move_floats_in_blocks_of_bounded_size(spark, monkeypatch):
    """Floats are not doubled in length on the way, and give what their doubles give."""
    random = np.random.default_rng(6)
    many = [(n, [float(x) for x in v]) for n, v in enumerate(random.normal(size=(60, 4)).astype("float32"))] + [(60, [-0.0, 0.0, 0.0, 1.0]), (61, [0.0, 0.0, 0.0, 1.0])]
    moved = []
    whole = neighbours._best_in_block

    def watched(count):
        best = whole(count)

        def block(table):
            assert str(table.schema.field("vector").type.value_type) == "float" and len(table) < 62
            return best(table)

        moved.append(count)
        return block

    doubles = nearest_items(spark.createDataFrame(many, "id long, v array<double>"), "id", "v", 5, 9)
    monkeypatch.setattr(neighbours, "_best_in_block", watched)
    floats = nearest_items(spark.createDataFrame(many, "id long, v array<float>"), "id", "v", 5, 9)
    assert sorted(rows(floats)) == sorted(rows(doubles)) and moved
    assert signature(nearest_items).parameters["block_rows"].default <= 20_000


def test_nearest_items_of_few(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])], "id long, v array<double>")
    got = rows(nearest_items(frame, "id", "v", 10).orderBy("id", "rank"), "id", "neighbour", "rank")
    assert got == [(1, 3, 1), (1, 2, 2), (2, 3, 1), (2, 1, 2), (3, 1, 1), (3, 2, 2)]
