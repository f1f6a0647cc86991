"""Operators for tables too large for all pairs, all values or all columns at once."""

import math
import re
import time
from pathlib import Path

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from marquee.models import factors, features, predictor, selection
from marquee.operators import density, gram, lsh, quantiles
from marquee.operators.neighbours import nearest_items
from marquee.operators.products import largest_products


@pytest.fixture(scope="module")
def clustered(spark):
    """600 vectors around 30 centres, with a common offset."""
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((30, 16)) * 3 + 2
    vectors = np.repeat(centres, 20, axis=0) + rng.standard_normal((600, 16))
    return spark.createDataFrame([(f"i{k:03d}", v.tolist()) for k, v in enumerate(vectors)], "id string, v array<double>")


def test_hashing_finds_neighbours_with_few_products(clustered):
    how = lsh.Hashing(tables=8, planes=12, block=32)
    found = lsh.approximate_neighbours(clustered, "id", "v", 5, how)
    exact = nearest_items(clustered, "id", "v", 5)
    judged = lsh.recall(found, exact, "id").first()
    assert judged.neighbours == 3000 and judged.recall >= 0.9
    pairs = lsh.compared_pairs(clustered, "id", "v", how).first()
    assert pairs.all_pairs == 600 * 599 // 2 and pairs.compared < 0.9 * pairs.all_pairs
    both = found.join(exact.withColumnRenamed("similarity", "exact"), ["id", "neighbour"])
    assert both.where("abs(similarity - exact) > 1e-9").count() == 0
    ranks = found.groupBy("id").agg(F.count("*").alias("n"), F.min("rank").alias("a"), F.max("rank").alias("b"))
    assert rows(ranks.select("n", "a", "b").distinct()) == [(5, 1, 5)]


def test_one_block_is_exact(clustered):
    some = clustered.where("id < 'i060'")
    found = lsh.approximate_neighbours(some, "id", "v", 4, lsh.Hashing(tables=1, planes=4, block=1000))
    exact = nearest_items(some, "id", "v", 4)
    assert sorted(rows(found, "id", "neighbour", "rank")) == sorted(rows(exact, "id", "neighbour", "rank"))


def test_hashing_takes_odd_rows(spark):
    schema = "id int, v array<double>"
    odd = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [1.0]), (None, [1.0, 1.0]), (7, [None, 1.0])]
    found = lsh.approximate_neighbours(spark.createDataFrame(odd, schema), "id", "v", 3)
    assert sorted(rows(found, "id", "neighbour", "rank")) == [(1, 2, 1), (2, 1, 1)]
    for few in ([], odd[:1], odd[2:4]):
        assert lsh.approximate_neighbours(spark.createDataFrame(few, schema), "id", "v").count() == 0
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(300)], schema)
    found = lsh.approximate_neighbours(same, "id", "v", 3, lsh.Hashing(2, 4, 16))
    assert found.count() == 900 and found.where("abs(similarity - 1) > 1e-9").count() == 0
    with pytest.raises(ValueError):
        lsh.Hashing(tables=0)


def best(users, items, seen, count):
    """All scores of every user, the plain way."""
    for user, vector in users.items():
        scored = sorted((-round(float(np.dot(vector, w)), 9), item) for item, w in items.items() if (user, item) not in seen)
        yield from ((user, item, rank + 1) for rank, (_, item) in enumerate(scored[:count]))


@pytest.mark.parametrize("block", [7, 4096])
def test_best_unseen_equals_brute_force(spark, block):
    rng = np.random.default_rng(3)
    users = {f"u{k}": np.round(rng.random(4), 1) for k in range(30)}
    items = {k: np.round(rng.random(4), 1) for k in range(25)}
    # One item that everybody has seen, one user who has seen all but three, repeated and unknown pairs.
    seen = {(u, 0) for u in users} | {("u1", k) for k in range(22)} | {("u2", 5), ("nobody", 3), ("u3", 999)}
    left = spark.createDataFrame([(u, v.tolist()) for u, v in users.items()], "user string, vector array<double>")
    right = spark.createDataFrame([(i, v.tolist()) for i, v in items.items()], "item long, vector array<double>")
    pairs = spark.createDataFrame([*seen, ("u2", 5)], "user string, item long")
    found = factors.best_unseen(left, right, pairs, "user", "item", 6, block)
    assert sorted(rows(found, "user", "item", "rank")) == sorted(best(users, items, seen, 6))
    none = factors.best_unseen(left.where("user = 'x'"), right, pairs, "user", "item")
    assert none.count() == 0


def test_best_unseen_with_floors_equals_brute_force(spark, monkeypatch):
    """Blocks hand on only what reaches the floor that the longest items set."""
    monkeypatch.setattr(factors, "LONGEST", 12)
    rng = np.random.default_rng(5)
    users = {k: np.round(rng.normal(size=3), 1) for k in range(40)}
    items = {k: np.round(rng.normal(size=3), 1) * (3 if k % 10 == 0 else 1) for k in range(120)}
    # One user has seen all long items but two, one all items but three, one nothing.
    seen = {(1, k) for k in range(0, 100, 10)} | {(2, k) for k in range(117)} | {(u, int(k)) for u in range(4, 40) for k in rng.integers(0, 120, 9)}
    left = spark.createDataFrame([(u, v.tolist()) for u, v in users.items()], "user long, vector array<double>")
    right = spark.createDataFrame([(i, v.tolist()) for i, v in items.items()], "item long, vector array<double>")
    pairs = spark.createDataFrame([*seen, (3, None), (None, 4)], "user long, item long")
    floored, whole = [], factors._with_floors
    monkeypatch.setattr(factors, "_with_floors", lambda *given: floored.append(whole(*given)) or floored[-1])
    found = factors.best_unseen(left, right, pairs, "user", "item", 4, 25)
    assert sorted(rows(found, "user", "item", "rank")) == sorted(best(users, items, seen, 4))
    assert len(floored) == 1 and 30 < floored[0].where("floor IS NOT NULL").count() < 40
    # Vectors of one length set no floor.
    alike = right.withColumn("vector", F.expr("array(1.0D, 0.0D, 0.0D)"))
    same = {k: np.array([1.0, 0.0, 0.0]) for k in range(120)}
    assert sorted(rows(factors.best_unseen(left, alike, pairs, "user", "item", 4, 25), "user", "item", "rank")) == sorted(best(users, same, seen, 4))
    assert "floor" not in floored[-1].columns


def test_products_below_a_floor_are_left_out():
    rng = np.random.default_rng(6)
    left, right = rng.random((30, 3)), rng.random((5000, 3)) * rng.random((5000, 1))
    products = (left @ right.T).round(9)
    floor = -np.sort(-products, axis=1)[:, 2]
    floor[:5] = -np.inf
    found = [(int(r), int(c)) for rows, places, _ in largest_products(6)(left, right, floor=floor) for r, c in zip(rows, places, strict=True)]
    assert found == [(r, int(c)) for r in range(30) for c in np.argsort(-products[r], kind="stable")[: 6 if r < 5 else 3]]
    assert not list(largest_products(6)(left, right, floor=np.full(30, 9.0)))


def test_factors_recommend_what_fits_and_is_not_rated(spark, tmp_path):
    # Two tastes: even users like even items, odd ones odd items.  Every user lacks two items of each kind.
    rated = spark.range(24 * 16).select(
        F.concat(F.lit("u"), F.col("id") % 24).alias("user"), F.floor(F.col("id") / 24).cast("int").alias("item"),
    ).select("user", "item", F.when(F.substring("user", 2, 9).cast("int") % 2 == F.col("item") % 2, 5.0).otherwise(1.0).alias("rating"))
    known = rated.where((F.substring("user", 2, 9).cast("int") + F.col("item")) % 8 > 1)
    fitted = factors.fit_factors(known, "user", "item", "rating", rank=4, blocks=2).save(str(tmp_path / "model"))
    again = factors.load_factors(spark, str(tmp_path / "model"), "user", "item")
    found = again.recommend(2)
    assert found.join(known, ["user", "item"]).count() == 0 and found.count() == 48
    liked = found.where("rank = 1").join(rated, ["user", "item"]).where("rating = 5.0").count()
    assert liked >= 22
    users = {r.user: np.array(r.vector) for r in fitted.users.collect()}
    items = {r.item: np.array(r.vector) for r in fitted.items.collect()}
    seen = set(rows(known.select("user", "item")))
    assert sorted(rows(found, "user", "item", "rank")) == sorted(best(users, items, seen, 2))
    one = spark.createDataFrame([("u3",), ("u3",), ("stranger",)], "user string")
    assert {r.user for r in again.recommend(1, one).collect()} == {"u3"}
    people = again.audience(3, spark.createDataFrame([(4,)], "item int"))
    assert [r.rank for r in people.orderBy("rank").collect()] == [1, 2, 3]
    assert people.join(known, ["user", "item"]).count() == 0


def test_only_pairs_of_the_asked_move(spark, monkeypatch):
    """Rated pairs of keys nobody asked for are left behind before blocks are formed."""
    known = spark.range(400).select((F.col("id") % 20).alias("user"), F.floor(F.col("id") / 20).alias("item"))
    users, items = (known.select(c).distinct().withColumn("vector", F.array(F.col(c).cast("float"), F.lit(1.0).cast("float"))) for c in ("user", "item"))
    model, moved = factors.Factors(users, items, known.where("(user + item) % 3 > 0"), "user", "item"), []
    whole = factors.best_unseen
    monkeypatch.setattr(factors, "best_unseen", lambda *given: moved.append(given[2].count()) or whole(*given))
    found = model.audience(2, spark.createDataFrame([(3,), (3,), (99,), (None,)], "item int"))
    assert moved == [13] and sorted(rows(found, "item", "user", "rank")) == [(3, 15, 2), (3, 18, 1)]
    assert model.recommend(1, spark.createDataFrame([(4,)], "user int")).count() == 1 and moved == [13, 14]
    assert model.recommend(1).count() == 20 and moved[2] == model.known.count()


def test_vocabulary_and_marks(spark):
    frame = spark.createDataFrame([(["B", "A"],), (["B", "B"],), (["A", "C", ""],), (None,), ([None, "B"],)], "g array<string>")
    assert features.fit_vocabulary(frame, "g") == ["B", "A", "C"]
    assert features.fit_vocabulary(frame, "g", most=1) == ["B"]
    assert features.fit_vocabulary(frame.where("g IS NULL"), "g") == []
    from pyspark.ml.functions import vector_to_array

    some = spark.createDataFrame([(["C", "B", "B", "new"],), ([],)], "g array<string>")
    marked = features.multi_hot(["B", "A", "C"], "g", "m").transform(some)
    assert rows(marked.select(vector_to_array("m"))) == [([1.0, 0.0, 1.0],), ([0.0, 0.0, 0.0],)]
    assert features.multi_hot([], "g", "m").transform(some).count() == 2


@pytest.fixture(scope="module")
def additive(spark):
    """Ratings that are sums over genres and grow with a number."""
    genre = F.array(F.lit("Drama"), F.lit("Horror"), F.lit("Comedy"))
    listed = F.concat_ws(",", F.when(F.col("id") % 2 == 0, genre[0]), F.when(F.col("id") % 3 == 0, genre[1]), F.when(F.col("id") % 5 < 2, genre[2]))
    value = (F.col("id") % 2 == 0).cast("int") * 2 + (F.col("id") % 3 == 0).cast("int") * 3 + F.col("size")
    frame = spark.range(600).withColumn("size", F.when(F.col("id") % 11 != 0, F.col("id") % 4))
    return frame.select(
        F.concat(F.lit("t"), "id").alias("tconst"), F.nullif(listed, F.lit("")).alias("genres"), "size",
        F.coalesce(value, F.lit(4)).cast("double").alias("averageRating"),
    )


def test_forest_is_chosen_and_survives_saving(spark, additive, tmp_path):
    train, test = additive.where("substring(tconst, 2) % 5 <> 0"), additive.where("substring(tconst, 2) % 5 = 0")
    forest = selection.TitleForest(numbers=["size"], trees=[8], depths=[1, 6], folds=2).fit(train)
    trials = forest.trials(spark).collect()
    assert [t.depth for t in trials] == [6, 1] and trials[0].rmse < trials[1].rmse
    judged = selection.judged(forest.predict(test), "averageRating").first()
    assert judged.rows == 120 and judged.share < 0.6
    forest.save(str(tmp_path / "forest"))
    loaded = selection.TitleForest.load(str(tmp_path / "forest"), numbers=["size"])
    both = loaded.predict(test).join(forest.predict(test).select("tconst", F.col("prediction").alias("p")), "tconst")
    assert both.count() == 120 and both.where("prediction <> p").count() == 0
    assert loaded.predict(test).columns == ["tconst", "genres", "averageRating", "size", "prediction"]
    with pytest.raises(ValueError):
        selection.TitleForest().predict(test)
    with pytest.raises(ValueError):
        selection.TitleForest().save("nowhere")


def test_unseen_combinations_have_features(spark, additive):
    both = F.coalesce(F.col("genres").contains("Drama") & F.col("genres").contains("Horror"), F.lit(False))
    forest = selection.TitleForest(numbers=["size"], trees=[20], depths=[6], folds=2).fit(additive.where(~both))
    told = forest.predict(additive.where(both)).agg(F.avg("prediction")).first()[0]
    other = forest.predict(additive.where("genres IS NULL")).agg(F.avg("prediction")).first()[0]
    assert told > other + 1
    odd = spark.createDataFrame([("x", None, None), ("y", "Unheard", 1), ("z", "", 2)], "tconst string, genres string, size int")
    assert forest.predict(odd).where("prediction IS NULL").count() == 0


def test_correlations_of_vectors(spark):
    rng = np.random.default_rng(2)
    matrix = rng.standard_normal((500, 6)) + 1e6
    matrix[:, 3] = matrix[:, 0] * 2 - matrix[:, 1]
    matrix[:, 5] = 7.0
    data = [(v.tolist(),) for v in matrix]
    odd = [(None,), ([1.0, 2.0],), ([float("nan")] * 6,), ([None] * 6,), ([float("inf")] * 6,)]
    found = gram.vector_correlations(spark.createDataFrame([*data, *odd], "v array<double>").repartition(13), "v")
    with np.errstate(all="ignore"):
        wanted = np.corrcoef(matrix.T)
    got = {(r.dim_x, r.dim_y): r.corr for r in found.collect()}
    assert len(got) == 36
    for (x, y), value in got.items():
        assert (value is None) == (5 in (x, y))
        assert value is None or value == pytest.approx(wanted[x, y], abs=1e-8)
    assert gram.vector_correlations(spark.createDataFrame(odd[:1], "v array<double>"), "v").count() == 0
    whole = gram.vector_correlations(spark.createDataFrame([([1, 2],), ([2, 1],)], "v array<int>"), "v")
    assert sorted(rows(whole)) == [(0, 0, pytest.approx(1)), (0, 1, pytest.approx(-1)), (1, 0, pytest.approx(-1)), (1, 1, pytest.approx(1))]


def test_sketches_merge_and_keep_their_error(spark):
    frame = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("key"), (F.col("id") % 7).alias("part"), (F.hash("id") / 1e3).alias("x")
    )
    fine = quantiles.quantile_sketches(frame, ["key", "part"], "x")
    found = quantiles.sketched_quantiles(quantiles.merged_sketches(fine, ["key"]), ["key"], [0.1, 0.5, 0.9])
    assert sorted(rows(found, "key", "n")) == [("a", 13334), ("b", 26666)]
    gaps = quantiles.rank_gap(frame, found, "key", "x", [0.1, 0.5, 0.9])
    assert all(g.gap <= 3 * quantiles.rank_error() for g in gaps.collect())
    assert quantiles.rank_error(4096) < quantiles.rank_error(1024) < 0.01
    wrong = found.withColumn("quantiles", F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0)))
    assert all(g.gap > 0.3 for g in quantiles.rank_gap(frame, wrong, "key", "x", [0.1, 0.5, 0.9]).collect())


def test_sketched_box_plot_of_few_values(spark):
    frame = spark.createDataFrame([("k", float(v)) for v in (1, 2, 3, 4, 100)] + [("k", None), (None, 5.0)], "key string, x double")
    got = {r.key: r for r in quantiles.sketched_box_plot(frame, "key", "x").collect()}
    assert (got["k"].q1, got["k"].median, got["k"].q3) == (2.0, 3.0, 4.0)
    assert (got["k"].whisker_low, got["k"].whisker_high, got["k"].n, got["k"].n_outliers) == (1.0, 4.0, 5, 1)
    assert got[None].n == 1
    assert quantiles.sketched_box_plot(frame.where("x > 1000"), "key", "x").count() == 0


def test_density_equals_the_formula(spark):
    values = [1.0, 1.0, 2.5, 4.0, 9.0]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),), (float("inf"),)], "x double")
    width = np.std(values, ddof=1) * len(values) ** -0.2
    got = rows(density.density_curve(frame, "x", points=9))
    for k, (x, value) in enumerate(got):
        assert x == pytest.approx(1 + k)
        wanted = sum(math.exp(-(((x - v) / width) ** 2) / 2) for v in values) / (len(values) * width * math.sqrt(2 * math.pi))
        assert value == pytest.approx(wanted)
    narrow = rows(density.density_curve(frame, "x", points=9, bandwidth=0.01))
    assert narrow[0][1] == pytest.approx(0.4 * 39.894228, rel=1e-6) and narrow[5][1] == 0.0
    for few in ("x = 9", "x > 100"):
        assert density.density_curve(frame.where("NOT isnan(x)").where(few).where("x < 1e9"), "x").count() == 0
    with pytest.raises(ValueError):
        density.density_curve(frame, "x", points=1)


def test_largest_products_equal_all_products():
    rng = np.random.default_rng(8)
    left, right = np.round(rng.random((40, 3)), 1), np.round(rng.random((333, 3)), 1)
    hidden = sorted({(int(r), int(c)) for r, c in zip(rng.integers(0, 40, 900), rng.integers(0, 333, 900), strict=True)})
    row, column = (np.array(side) for side in zip(*hidden, strict=True))
    products = left @ right.T
    products[row, column] = -np.inf
    for count in (1, 5, 400):
        found = [(int(r), int(c)) for rows, places, _ in largest_products(count)(left, right, row, column) for r, c in zip(rows, places, strict=True)]
        wanted = [(r, int(c)) for r in range(40) for c in np.argsort(-products[r].round(9), kind="stable")[:count]]
        assert found == wanted


def test_blocks_of_nearest_items_follow_different_vectors(spark):
    """Many items of few vectors must not make many blocks, and only keys of them move."""
    frame = spark.range(3000).select("id", F.array((F.col("id") % 3).cast("double"), F.lit(1.0)).alias("v"))
    found = nearest_items(frame, "id", "v", 3, block_rows=10)
    dealt = [int(n) for n in re.findall(r"pmod\(xxhash64\(item#\w+, 42\), (\d+)\)", found._jdf.queryExecution().optimizedPlan().toString())]
    assert dealt and min(dealt) <= 8
    assert found.count() == 9000 and found.where("abs(similarity - 1) > 1e-9").count() == 0


def counted_rows(spark, frame):
    """The frame, and how many of its rows have been computed so far."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def mark(value):
        seen.add(1)
        return value

    return frame.withColumn("averageRating", mark.asNondeterministic()("averageRating")), seen


def test_forests_compute_their_rows_once(spark, additive):
    frame, seen = counted_rows(spark, additive)
    selection.TitleForest("averageRating", ["size"], trees=[2], depths=[2], folds=2).fit(frame)
    assert 600 <= seen.value <= 1200
    frame, seen = counted_rows(spark, additive)
    predictor.RatingPredictor(trees=2, depth=2).fit(frame)
    assert 0 < seen.value <= 1200


def test_rows_of_a_forest_are_stored_for_all_tasks(spark, additive, monkeypatch):
    """However few bytes the rows have, and however few tasks they come from, many tasks can read them."""
    files, store = [], selection.stored_once

    def watched(frame, purpose):
        files.append(len(set(store(frame, purpose).inputFiles())))
        return store(frame, purpose)

    monkeypatch.setattr(selection, "stored_once", watched)
    selection.TitleForest("averageRating", ["size"], trees=[2], depths=[2], folds=2).fit(additive.coalesce(1))
    assert files == [8]


def test_shuffles_of_a_factorisation_go_with_its_iterations(spark):
    local = [Path(str(f)) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffles = lambda: {f.name.split("_")[1] for top in local for f in top.rglob("shuffle_*")}
    rated = spark.range(400).select((F.col("id") % 20).alias("u"), F.floor(F.col("id") / 20).alias("i"), (F.col("id") % 7).cast("double").alias("r"))
    before = shuffles()
    fitted = factors.fit_factors(rated, "u", "i", "r", rank=2, iterations=8, blocks=2)
    for _ in range(100):
        if len(shuffles() - before) <= 12:
            break
        time.sleep(0.1)
    assert len(shuffles() - before) <= 12
    assert fitted.users.count() == 20


def test_products_are_left_out_by_length():
    """Columns much shorter than the best ones are not multiplied; results stay those of all products."""
    rng = np.random.default_rng(4)
    left, right = rng.random((50, 4)), rng.random((9000, 4)) * np.repeat([0.01, 1.0, 0.02], 3000)[:, None]

    class Counted(np.ndarray):
        made = 0

        def __matmul__(self, other):
            Counted.made += len(self) * other.shape[1]
            return np.asarray(self) @ np.asarray(other)

    found = list(largest_products(3)(left.view(Counted), right))
    products = left @ right.T
    wanted = np.argsort(-products.round(9), axis=1, kind="stable")[:, :3]
    assert (np.concatenate([np.asarray(places) for _, places, _ in found]).reshape(50, 3) == wanted).all()
    assert 0 < Counted.made <= 50 * 4096


def test_vectors_move_packed_and_in_few_blocks(spark):
    """Copies of vectors grow with the root of the number of blocks, and a row holds many of them."""
    assert factors._blocks(900_000, 1_200_000, 10, 48, 200_000) == (8, 6)
    assert factors._blocks(0, 0, 10, 8, 200_000) == (8, 1) and factors._blocks(5, 900, 3, 8, 100) == (1, 9)
    frame = spark.range(5000).select("id", F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("vector"))
    packs = factors._packed(frame, "id", 5000, 2, "_row").collect()
    assert len(packs) <= 4 and sorted(k for p in packs for k in p.keys) == list(range(5000))
    assert all([float(k), 1.0] == p.vectors[2 * n : 2 * n + 2] for p in packs for n, k in enumerate(p.keys))
    uneven = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id long, vector array<double>")
    with pytest.raises(Exception, match="vectors of different lengths"):
        nothing = spark.createDataFrame([], "u long, i long")
        factors.best_unseen(uneven.withColumnRenamed("id", "u"), uneven.withColumnRenamed("id", "i"), nothing, "u", "i").collect()
