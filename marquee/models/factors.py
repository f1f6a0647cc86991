"""Collaborative scores by matrix factorisation, and recommendations of what is not rated yet."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.functions.columns import dot, settled
from marquee.operators.ids import dense_ids
from marquee.operators.products import largest_products
from marquee.operators.skew import spread_join
from marquee.sources.catalogue import join_path
from marquee.sources.scratch import stored_once


#: Users or items of a block at most.  Every block of users meets every block of items, so that larger ones mean fewer copies of vectors.
BLOCK_ROWS = 500_000
#: Of several times so many items about so many longest ones say first what a user's best are at least.
LONGEST = 50_000
#: Vectors that move as one row, and bytes that a copy of a vector and a found item take about.
PACKED, COPY_BYTES, FOUND_BYTES = 1000, 50, 30
#: Blocks of a factorisation that are enough for few ratings, and ratings of one at most; a vector moves to each block that has a rating of it.
ENOUGH, RATINGS = 16, 4_000_000


def one_user_scores(rated: DataFrame, item: str, rating: str, reg: float = 0.1) -> DataFrame:
    """Scores when a single user gave all ratings: ``item, cf_score``.

    With one user vector u every item vector is r * u / (|u|^2 + reg), and the
    weighted regularised loss is least at |u|^2 = rms - reg, where rms is the
    root mean square rating.  So the score is r * (1 - reg / rms), and 0 if rms
    is not above reg.  This is where the iterations end up from any start; a
    few of them stop short of it by a share that depends on the seed.  One
    aggregate replaces them, since they would hold all ratings of the one user
    in a single block.
    """
    known = rated.where(F.col(rating).isNotNull())
    squares = F.pow(F.col(rating).cast("double"), F.lit(2.0))
    rms = known.agg(F.sqrt(F.avg(squares))).scalar()
    kept = F.greatest(F.lit(0.0), 1 - F.try_divide(F.lit(float(reg)), rms))
    return known.select(item, (F.col(rating).cast("double") * F.coalesce(kept, F.lit(0.0))).alias("cf_score"))


@dataclass(frozen=True)
class Factors:
    """Fitted vectors by the original keys: ``users`` and ``items`` with the key and ``vector`` (of floats, as they were fitted), and the
    rated pairs ``known``, as often as they were rated."""

    users: DataFrame
    items: DataFrame
    known: DataFrame
    user: str
    item: str

    def save(self, path: str) -> "Factors":
        """Writes the three tables below ``path`` and returns the model read back from there."""
        for name in ("users", "items", "known"):
            getattr(self, name).write.mode("overwrite").parquet(join_path(path, name))
        return load_factors(self.users.sparkSession, path, self.user, self.item)

    def scores(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose user and item both have a vector, with ``cf_score``."""
        left = self.users.withColumnRenamed("vector", "_user")
        right = self.items.withColumnRenamed("vector", "_item")
        both = spread_join(spread_join(pairs, left, self.user, [self.item]), right, self.item, [self.user])
        return both.withColumn("cf_score", dot(F.col("_user"), F.col("_item"))).drop("_user", "_item")

    def recommend(self, count: int = 10, asked: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
        """The ``count`` items of the highest score for each user that the user has not rated; see :func:`best_unseen`.

        ``asked`` lists the users to serve, by default all.
        """
        users, known = _of_asked(self.users, self.known, self.user, asked)
        return best_unseen(users, self.items, known, self.user, self.item, count, block_rows)

    def audience(self, count: int = 10, asked: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
        """The ``count`` users of the highest score for each item who have not rated it."""
        items, known = _of_asked(self.items, self.known, self.item, asked)
        return best_unseen(items, self.users, known, self.item, self.user, count, block_rows)


def _of_asked(vectors: DataFrame, known: DataFrame, key: str, asked: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The vectors and the rated pairs of the keys in ``asked``, or all of them; no others can be left out of a result."""
    if asked is None:
        return vectors, known
    keys = asked.select(key).distinct()
    return vectors.join(keys, key), known.join(keys, key, "left_semi").select(known.columns)


def load_factors(spark: SparkSession, path: str, user: str, item: str) -> Factors:
    """A model that :meth:`Factors.save` has written, in any session."""
    return Factors(*(spark.read.parquet(join_path(path, name)) for name in ("users", "items", "known")), user, item)


def fit_factors(
    rated: DataFrame,
    user: str,
    item: str,
    rating: str,
    rank: int = 10,
    iterations: int = 10,
    reg: float = 0.1,
    seed: int = 42,
    blocks: int | None = None,
) -> Factors:
    """Non-negative ALS for many users.  Rows without user, item or rating take no part.

    The numbers of users and items and the numbered ratings are stored once.  Where the context has a checkpoint folder, every iteration is checkpointed, upon which ALS
    deletes the shuffle files of the one before: each has a vector per rating at worst.
    """
    known = rated.select(user, item, rating).dropna()
    users, items = (stored_once(dense_ids(known, key, name), "ids") for key, name in ((user, "_user"), (item, "_item")))
    numbered = known.join(users, user).join(items, item).withColumn("_rating", F.col(rating).cast("float"))
    numbered = stored_once(numbered.select(user, item, "_user", "_item", "_rating"), "numbered")
    if blocks is None:
        partitions = int(rated.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        blocks = min(partitions, max(ENOUGH, ceil(numbered.count() / RATINGS)))
    model = (
        ALS(
            userCol="_user",
            itemCol="_item",
            ratingCol="_rating",
            rank=rank,
            maxIter=iterations,
            regParam=reg,
            nonnegative=True,
            checkpointInterval=1,
            coldStartStrategy="drop",
            seed=seed,
        )
        .setNumBlocks(blocks)
        .fit(numbered)
    )

    def named(ids: DataFrame, key: str, fitted: DataFrame) -> DataFrame:
        both = ids.join(fitted.withColumnRenamed("id", ids.columns[1]), ids.columns[1])
        return both.select(key, F.col("features").alias("vector"))

    return Factors(named(users, user, model.userFactors), named(items, item, model.itemFactors), numbered.select(user, item), user, item)


def factor_scores(
    rated: DataFrame,
    user: str,
    item: str,
    rating: str,
    rank: int = 10,
    iterations: int = 10,
    reg: float = 0.1,
    seed: int = 42,
    blocks: int | None = None,
) -> DataFrame:
    """Non-negative ALS for many users: the score of each rated (user, item)."""
    fitted = fit_factors(rated, user, item, rating, rank, iterations, reg, seed, blocks)
    return fitted.scores(rated.where(F.col(rating).isNotNull()).select(user, item))


def _packed(vectors: DataFrame, key: str, rows: int, blocks: int, name: str) -> DataFrame:
    """The vectors of each of ``blocks`` blocks in rows of about ``PACKED``: the block as ``name``, ``keys``, ``vectors`` end to end, the
    smallest and largest length of a vector, ``least`` and ``most``, and ``floors``, null without a column ``floor``."""
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias(name)
    pack = F.pmod(F.xxhash64(F.lit("pack"), key), F.lit(max(1, rows // blocks // PACKED))).alias("_pack")
    size = F.coalesce(F.size("vector"), F.lit(-1))
    floor = (F.col("floor") if "floor" in vectors.columns else F.lit(None)).cast("double").alias("floor")
    many = vectors.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), "vector", floor, block, pack)
    lists = many.groupBy(name, "_pack").agg(
        F.collect_list(F.struct("key", "vector", "floor")).alias("many"), F.min(size).alias("least"), F.max(size).alias("most")
    )
    ends = F.flatten(F.transform("many", lambda one: one["vector"])).alias("vectors")
    floors = (F.transform("many", lambda one: one["floor"]) if "floor" in vectors.columns else F.lit(None).cast("array<double>")).alias("floors")
    return lists.select(name, F.transform("many", lambda one: one["key"]).alias("keys"), ends, "least", "most", floors)


def _blocks(users: int, items: int, count: int, tasks: int, block_rows: int) -> tuple[int, int]:
    """Blocks of users and of items: ``tasks`` pairs or more, none larger than ``block_rows``, and few bytes to move.

    A user's vector and ``count`` results move for each block of items, an item's vector for each block of users.
    """
    rows, columns = (max(1, ceil(n / block_rows)) for n in (users, items))
    best = (COPY_BYTES * items * tasks / ((COPY_BYTES + FOUND_BYTES * count) * max(1, users))) ** 0.5
    columns = max(columns, min(tasks, round(best)))
    return max(rows, ceil(tasks / columns)), columns


def _best_of_block(user: str, item: str, count: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The best unseen items of a block for each user of a block.  All is local, so that tasks need not import this package."""
    largest = largest_products(count)

    def unpacked(packs: pa.Table, keys: str) -> tuple[pa.Array, np.ndarray]:
        names = pc.list_flatten(packs[keys]).combine_chunks()
        sizes = {*packs["least"].to_pylist(), *packs["most"].to_pylist()}
        if len(sizes) > 1:
            raise ValueError("vectors of different lengths")
        return names, np.asarray(pc.list_flatten(packs["vectors"]), "float64").reshape(len(names), max(sizes, default=0))

    def best(packs: pa.Table, seen: pa.Table) -> pa.Table:
        asks = pc.is_valid(packs["_users"])
        users, left = unpacked(packs.filter(asks), "_users")
        items, right = unpacked(packs.filter(pc.invert(asks)), "_items")
        floors = pc.list_flatten(packs.filter(asks)["floors"]).combine_chunks()
        found = pa.table({user: users[:0], item: items[:0], "cf_score": pa.array([], pa.float64())})
        if not len(users) or not len(items):
            return found
        order = pc.sort_indices(items)
        items, right = items.take(order), right[order.to_numpy()]
        row, column = (np.asarray(pc.index_in(seen[c], value_set=v).fill_null(-1)) for c, v in (("_user", users), ("_item", items)))
        there = (row >= 0) & (column >= 0)
        order = np.argsort(row[there], kind="stable")
        parts = [found]
        known = pc.fill_null(floors, -np.inf).to_numpy(zero_copy_only=False) if len(floors) else None
        for rows, places, value in largest(left, right, row[there][order], column[there][order], known):
            unseen = np.isfinite(value)
            parts.append(
                pa.table(
                    {
                        user: users.take(pa.array(rows[unseen])),
                        item: items.take(pa.array(places[unseen])),
                        "cf_score": pa.array(value[unseen]),
                    }
                )
            )
        return pa.concat_tables(parts)

    return best


def _with_floors(
    users: DataFrame, items: DataFrame, seen: DataFrame, user: str, item: str, count: int, share: float, block_rows: int
) -> DataFrame:
    """``users`` with ``floor``, which ``count`` unseen items of each reach: the ``count``-th best of about the ``share`` of longest vectors.

    It is null for users with fewer unseen ones among these.  Any part of the items gives a floor that holds, so that an approximate limit will do.
    """
    square = F.aggregate("vector", F.lit(0.0), lambda sofar, x: sofar + x.cast("double") * x.cast("double"))
    # A vector that is no number would be the longest, and its products count for nothing.
    square = F.when(~F.isnan(square), square)
    least = items.agg(F.percentile_approx(square, 1 - share, min(1_000_000, max(10_000, round(20 / share))))).first()[0]
    long = stored_once(items.where(square >= F.lit(least)).select(item, "vector"), "longest")
    # Of many vectors as long as the limit none is better than another.
    if not 0 < long.count() <= 2 * LONGEST:
        return users
    some = seen.join(long.select(item), item, "left_semi").select(seen.columns)
    best = best_unseen(users, long, some, user, item, count, block_rows)
    floors = best.where(F.col("rank") == count).select(F.col(user).alias("_floor_of"), F.col("cf_score").alias("floor"))
    joined = users.join(floors, F.col(user) == F.col("_floor_of"), "left").select(*users.columns, "floor")
    return stored_once(joined, "floors")


def best_unseen(
    users: DataFrame, items: DataFrame, seen: DataFrame, user: str, item: str, count: int = 10, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``user, item, cf_score, rank``: for each user the ``count`` items of the largest product of vectors, ties by item.

    ``users`` and ``items`` have their key and ``vector``, keys unique, vectors of one size; pairs in ``seen`` are left out.  Users and items
    are dealt into blocks of about ``block_rows`` at most; each pair of blocks is worked on in one task with the seen pairs of
    these blocks, so that a user or an item in very many pairs is spread, and only the best leave a task.  Vectors move packed, a
    row for many.  All pairs are decided, those of short vectors without their product, see :func:`largest_products`: at worst the work
    grows with users times items.  Of very many items in several blocks the longest, which most products as large are of, go first: a
    user's ``count``-th best of these is a floor, below which no block looks or hands on rows.  Without users or items there are no rows.
    """
    session = users.sparkSession
    partitions = int(session.conf.get("spark.sql.shuffle.partitions"))
    # A few for each core.
    tasks = min(partitions, 4 * session.sparkContext.defaultParallelism)
    asked, given = users.count(), items.count()
    rows, columns = _blocks(asked, given, count, tasks, block_rows)
    if columns > 1 and given > 4 * LONGEST:
        users = _with_floors(users, items, seen, user, item, count, LONGEST / given, block_rows)

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    single = all(f.schema["vector"].dataType.simpleString() == "array<float>" for f in (users, items))
    vectors = F.col("vectors").cast("array<float>" if single else "array<double>").alias("vectors")
    user_kind, item_kind = users.schema[user].dataType, items.schema[item].dataType
    asking = _packed(users, user, asked, rows, "_row").select(
        F.col("keys").alias("_users"), F.lit(None).cast(f"array<{item_kind.simpleString()}>").alias("_items"), vectors, "least", "most", "floors",
        "_row", every(columns).alias("_column"),
    )
    offered = _packed(items, item, given, columns, "_column").select(
        F.lit(None).cast(f"array<{user_kind.simpleString()}>").alias("_users"), F.col("keys").alias("_items"), vectors, "least", "most", "floors",
        every(rows).alias("_row"), "_column",
    )

    def dealt(name: str, blocks: int) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(blocks)).cast("int")

    pairs = seen.select(F.col(user).cast(user_kind).alias("_user"), F.col(item).cast(item_kind).alias("_item"))
    pairs = pairs.select("*", dealt("_user", rows).alias("_row"), dealt("_item", columns).alias("_column"))
    block = ["_row", "_column"]
    # The number is given, and several times that of the blocks, for Spark puts small parts together by their bytes.
    apart = 4 * rows * columns
    scored = (
        asking.unionByName(offered)
        .repartition(apart, *block)
        .groupBy(*block)
        .cogroup(pairs.repartition(apart, *block).groupBy(*block))
        .applyInArrow(
            _best_of_block(user, item, count),
            f"`{user}` {user_kind.simpleString()}, `{item}` {item_kind.simpleString()}, cf_score double",
        )
    )
    ranking = Window.partitionBy(user).orderBy(F.desc(settled(F.col("cf_score"))), item)
    return scored.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= count)
