"""Approximate nearest neighbours by learned partitions.

The neighbour graph of a sample is cut into parts of nearly equal size with few neighbours apart.  A small
network learns to tell, from a vector alone, in which parts its neighbours are.  Every vector
is filed under its most probable part; a query looks into several probable parts and ranks all
it finds there by the exact cosine.

A part that more than ``SPLIT`` vectors are filed under is parted again in the same way, by a network of its own that one task
fits on a sample of that part.  So there are more parts in a larger table: up to 64 times 64.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.sampling import hashed_sample
from marquee.llm.shipping import in_tasks, ship
from marquee.llm.storage import drop, stored

#: Vectors of a part that one task holds, and queries that it answers.
BLOCK, ASKED = 4096, 4096
#: Vectors of a part before it is parted again, vectors for each of its parts, and the vectors that such a split is learned from.
SPLIT, PART, PART_SAMPLE = 16_384, 1024, 4096
#: More than matrix products can differ from the exact cosine.
MARGIN = 1e-9


Layers = list[tuple[np.ndarray, np.ndarray]]


def _log_odds(layers: Layers, points: np.ndarray) -> np.ndarray:
    """Logarithms of the probabilities that a network gives to its parts."""
    (first, one), (second, two) = layers
    raw = np.maximum(points @ first + one, 0) @ second + two
    raw = raw - raw.max(axis=1, keepdims=True)
    return raw - np.log(np.exp(raw).sum(axis=1, keepdims=True))


@dataclass(frozen=True)
class Router:
    """Probabilities of parts for a vector, and how many parts a query looks into.

    ``below`` has the networks of those parts of the first level that are parted again.
    """

    dimension: int
    probes: int
    layers: Layers
    below: dict[int, Layers] = field(default_factory=dict)

    @property
    def tops(self) -> int:
        return len(self.layers[1][1])

    @property
    def parts(self) -> int:
        return sum(len(self.below[p][1][1]) if p in self.below else 1 for p in range(self.tops))

    def odds(self, points: np.ndarray) -> np.ndarray:
        """Per vector the logarithms of the probabilities of all parts, parts of a part side by side."""
        top = _log_odds(self.layers, points)
        columns = [top[:, p : p + 1] + (_log_odds(self.below[p], points) if p in self.below else 0.0) for p in range(self.tops)]
        return np.concatenate(columns, axis=1)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def neighbour_graph(points: np.ndarray, count: int, step: int = 512) -> np.ndarray:
    """The ``count`` nearest other points of each."""
    found = []
    for begin in range(0, len(points), step):
        near = points[begin : begin + step] @ points.T
        near[np.arange(len(near)), begin + np.arange(len(near))] = -np.inf
        found.append(np.argpartition(-near, count - 1, axis=1)[:, :count])
    return np.concatenate(found)


def balanced_parts(points: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 0.1) -> np.ndarray:
    """A part for each point; none has more than its share and ``slack``, and few edges cross.

    Begins with the nearest of some points far from each other and moves points, the surest first, to where
    most of their neighbours are while there is room.
    """
    count = len(points)
    room = int(np.ceil(count / parts * (1 + slack)))
    seeds, nearest = [0], points @ points[0]
    for _ in range(parts - 1):
        seeds.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, points @ points[seeds[-1]])
    centres = points[seeds]
    both = np.concatenate([np.stack([np.repeat(np.arange(count), graph.shape[1]), graph.ravel()], 1)] * 2)
    half = len(both) // 2
    both[half:] = both[half:, ::-1]
    part = np.zeros(count, np.int64)
    for turn in range(rounds):
        if turn < 4:  # first by position, then by the graph
            wish = points @ centres.T
        else:
            wish = np.zeros((count, parts))
            np.add.at(wish, (both[:, 0], part[both[:, 1]]), 1.0)
            wish += 0.5 * np.eye(parts)[part]
        ranked = np.sort(wish, axis=1)
        sure = ranked[:, -1] - (ranked[:, -2] if parts > 1 else 0)
        left, choice = np.full(parts, room), np.argsort(-wish, axis=1)
        for k in np.argsort(-sure):
            part[k] = next(p for p in choice[k] if left[p])
            left[part[k]] -= 1
        for p in range(parts):
            if (part == p).any():
                centre = points[part == p].mean(axis=0)
                centres[p] = centre / max(np.linalg.norm(centre), 1e-12)
    return part


def train(points: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 60, seed: int = 11) -> list[tuple[np.ndarray, np.ndarray]]:
    """A network of one hidden layer, by Adam on the cross entropy with ``target`` distributions."""
    rng = np.random.default_rng(seed)
    sizes = (points.shape[1], hidden, target.shape[1])
    weights = [rng.normal(0, np.sqrt(2 / a), (a, b)) for a, b in zip(sizes, sizes[1:], strict=False)]
    values = [weights[0], np.zeros(hidden), weights[1], np.zeros(sizes[2])]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(points))
        for begin in range(0, len(order), 256):
            x, wanted = points[order[begin : begin + 256]], target[order[begin : begin + 256]]
            inner = np.maximum(x @ values[0] + values[1], 0)
            raw = inner @ values[2] + values[3]
            odds = np.exp(raw - raw.max(axis=1, keepdims=True))
            error = (odds / odds.sum(axis=1, keepdims=True) - wanted) / len(x)
            back = (error @ values[2].T) * (inner > 0)
            slopes = [x.T @ back, back.sum(axis=0), inner.T @ error, error.sum(axis=0)]
            step += 1
            for k, slope in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                values[k] -= 0.003 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return [(values[0], values[1]), (values[2], values[3])]


def fit_parts(points: np.ndarray, parts: int, neighbours: int = 10) -> Layers:
    """A network that tells the parts of the neighbour graph of different vectors of length one."""
    dimension = points.shape[1]
    if parts == 1:
        return [(np.zeros((dimension, 1)), np.zeros(1)), (np.zeros((1, 1)), np.zeros(1))]
    graph = neighbour_graph(points, min(neighbours, len(points) - 1))
    part = balanced_parts(points, graph, parts)
    # Where a point and its neighbours are.
    target = np.eye(parts)[part] + np.eye(parts)[part[graph]].mean(axis=1)
    return train(points, target / target.sum(axis=1, keepdims=True))


def distinct_units(sample: np.ndarray) -> np.ndarray:
    return np.unique(unit(sample), axis=0) if len(sample) else sample


def parts_for(rows: int) -> int:
    """Parts of so many sampled vectors: 64 vectors tell a part, and a network has 64 parts at most."""
    return max(1, min(64, rows // 64))


def calibrated(router: Router, points: np.ndarray, count: int, recall: float) -> Router:
    """The router with as many probes as the sample's own neighbours ask for."""
    if router.parts == 1 or len(points) < 2:
        return replace(router, probes=1)
    odds = router.odds(points)
    place = np.argsort(np.argsort(-odds, axis=1), axis=1)
    filed = odds.argmax(axis=1)
    near = neighbour_graph(points, min(count, len(points) - 1))
    rank = np.take_along_axis(place, filed[near], axis=1)
    reached = np.cumsum(np.bincount(rank.ravel(), minlength=router.parts)) / rank.size
    return replace(router, probes=1 + int(np.argmax(reached >= recall)))


def fit(sample: np.ndarray, count: int, recall: float = 0.97) -> Router:
    """A router of one level from a sample of vectors; all in one part if there are less than 128 different ones."""
    points = distinct_units(sample)
    layers = fit_parts(points, parts_for(len(points))) if len(points) else fit_parts(np.zeros((0, sample.shape[1])), 1)
    return calibrated(Router(sample.shape[1], 1, layers), points, count, recall)


def usable(vector: Column) -> Column:
    """Not null, and of finite components of which one at least is not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(lists.flatten(), dtype=np.float64).reshape(-1, dimension)


def _filed(shared: Callable[[], Router]) -> Callable:
    """Adds to every row its most probable ``part``."""

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = shared()
        for batch in batches:
            if batch.num_rows:
                odds = router.odds(unit(_matrix(batch.column(1), router.dimension)))
                part = pa.array(odds.argmax(axis=1).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), part], ["id", "vector", "part"])

    return route


def _probing(shared: Callable[[], Router], sizes: np.ndarray, count: int) -> Callable:
    """Adds to every query the parts that it looks into: the probable ones, and more where these hold ``count`` vectors or less."""

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = shared()
        for batch in batches:
            if batch.num_rows:
                odds = router.odds(unit(_matrix(batch.column(1), router.dimension)))
                order = np.argsort(-odds, axis=1, kind="stable").astype(np.int32)
                before = np.cumsum(sizes[order], axis=1) - sizes[order]
                wanted = (np.arange(order.shape[1]) < router.probes) | (before <= count)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(wanted.sum(axis=1))]).astype(np.int32)), pa.array(order[wanted])
                )
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["id", "vector", "part"])

    return probe


def _split_parts(spark: SparkSession, filed: DataFrame, sizes: dict[int, int]) -> dict[int, Layers]:
    """Networks of the parts that hold more than ``SPLIT`` vectors, each fitted in a task on a bounded sample of its part."""
    large = {p: n for p, n in sizes.items() if n > SPLIT}
    if not large:
        return {}
    steps = 1 << 30
    # About twice as many as are wanted; the task takes the first of them by their hash.
    below = F.create_map(*(F.lit(x) for p, n in sorted(large.items()) for x in (p, min(steps, 1 + 2 * PART_SAMPLE * steps // n))))
    hashed = F.pmod(F.xxhash64("id", "vector"), F.lit(steps))
    some = filed.where(F.col("part").isin(sorted(large))).withColumn("order", hashed).where(F.col("order") < below[F.col("part")])
    most = PART_SAMPLE
    parts = {p: max(2, min(64, -(-n // PART))) for p, n in large.items()}

    def learn(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        first = table.sort_by([("order", "ascending"), ("id", "ascending")]).slice(0, most)
        points = distinct_units(_matrix(first["vector"], len(first["vector"][0])))
        made = min(parts[part], parts_for(len(points)))
        return pa.table({"part": pa.array([part], pa.int32()), "layers": pa.array([pickle.dumps(fit_parts(points, made))], pa.binary())})

    found = some.select("part", "id", "vector", "order").groupBy("part").applyInArrow(learn, "part int, layers binary")
    # At most 64 networks.
    return {row["part"]: pickle.loads(row["layers"]) for row in found.collect()}


def _ranked(count: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """The ``count`` nearest vectors of a block for each query, by the exact cosine, ties to the smaller id."""

    def length(rows: np.ndarray) -> np.ndarray:
        return np.sqrt((rows * rows).sum(axis=1))

    def rank(key: tuple, asked: pa.Table, offered: pa.Table) -> pa.Table:  # noqa: ARG001
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if asked.num_rows and offered.num_rows:
            dimension = len(asked["vector"][0])
            query, name = _matrix(asked["vector"], dimension), np.asarray(asked["id"])
            vector, item = _matrix(offered["vector"], dimension), np.asarray(offered["id"])
            order = np.argsort(item, kind="stable")
            vector, item = vector[order], item[order]
            # Equal vectors tie: of each, the first few ids (one may be the query's own) are enough.
            same, first, back = np.unique(vector, axis=0, return_index=True, return_inverse=True)
            back = back.ravel()
            copies = np.argsort(back, kind="stable")
            ends = np.searchsorted(back[copies], np.arange(len(same) + 1))
            few = [copies[a : min(b, a + count + 1)] for a, b in zip(ends, ends[1:], strict=False)]
            kept = min(count + 1, len(same))
            columns = unit(same).T
            for begin in range(0, len(query), 256):
                part, names = query[begin : begin + 256], name[begin : begin + 256]
                near = unit(part) @ columns
                floor = np.partition(near, -kept, axis=1)[:, -kept]
                rows, places = np.nonzero(near >= floor[:, None] - MARGIN)
                rows, places = (
                    np.concatenate([np.full(len(few[p]), r) for r, p in zip(rows, places, strict=True)]),
                    np.concatenate([few[p] for p in places]),
                )
                other = names[rows] != item[places]
                rows, places = rows[other], places[other]
                a, b = part[rows], vector[places]
                score = (a * b).sum(axis=1) / (length(a) * length(b))
                order = np.lexsort((item[places], -score, rows))
                rows, places, score = rows[order], places[order], score[order]
                best = np.arange(len(rows)) - np.searchsorted(rows, rows) < count
                found.append((names[rows[best]], item[places[best]], score[best]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query", "item", "score"), columns, kinds, strict=True)})

    return rank


def search(
    spark: SparkSession,
    vectors: DataFrame,
    is_query: Column,
    count: int = 5,
    sample: int = 4096,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    recall: float = 0.97,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), the other's id and ``score`` for the ``count`` nearest found of each query.

    All rows are indexed; ``is_query`` (of the columns of ``vectors``) says which of them ask.  The score is the
    cosine of the given vectors in double precision; ties go to the smaller id.  A query's own id never is
    its answer.  The router is fitted on at most ``sample`` rows, chosen by a hash, and where parts are parted again
    on ``PART_SAMPLE`` rows of each; ``recall`` is what share of the sample's own neighbours it must reach, which sets how many
    parts a query looks into.  With fewer than 128 different vectors in the sample there is one part, and the search is exact.
    Vectors that are null, zero, or hold null or non-finite components take no part, nor do null ids and
    vectors that are not as long as most are.  Rows that repeat an id are vectors of their own: each asks and
    answers, under one id, but none of them answers that id itself.  Fewer answers than ``count`` come only if there are no more vectors.
    """
    ship(spark)
    vector = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    read = vectors.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    read = read.where(F.col("id").isNotNull() & usable(F.col("vector")))
    # The size that most vectors have; of equally frequent ones the largest.
    lengths = read.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("rows"))
    most = lengths.agg(F.max(F.struct("rows", "size")).alias("most")).first()["most"]
    dimension = most["size"] if most else 0
    fitting = read.where(F.size("vector") == dimension)
    chosen = hashed_sample(fitting.select("id", "vector"), ["id", "vector"], sample).toArrow()["vector"].to_pylist()
    chosen = np.array(chosen, dtype=np.float64).reshape(len(chosen), dimension)
    router = fit(chosen, count, recall)
    held = spark.sparkContext.broadcast(router)
    named = "id long, vector array<double>, part int"
    filed = stored(spark, in_tasks(fitting.select("id", "vector"), _filed(lambda: held.value), named), "index")

    def sizes_of(frame: DataFrame) -> dict[int, int]:
        # One number per part.
        return {r["part"]: r["n"] for r in frame.groupBy("part").agg(F.count("*").alias("n")).collect()}

    sizes = sizes_of(filed)
    below = _split_parts(spark, filed, sizes)
    if below:
        router = calibrated(replace(router, below=below), distinct_units(chosen), count, recall)
        held = spark.sparkContext.broadcast(router)
        again = stored(spark, in_tasks(filed.select("id", "vector"), _filed(lambda: held.value), named), "index")
        drop(spark, filed)
        filed, sizes = again, sizes_of(again)
    counts = np.array([sizes.get(p, 0) for p in range(router.parts)], dtype=np.int64)
    blocks = F.array(*(F.lit(max(1, -(-int(n) // BLOCK))) for n in counts))
    probing = _probing(lambda: held.value, counts, count)
    asks = in_tasks(fitting.where("asks").select("id", "vector"), probing, "id long, vector array<double>, part array<int>")
    asks = stored(spark, asks.select("id", "vector", F.explode("part").alias("part")), "asks")
    many = sizes_of(asks)
    chunks = F.array(*(F.lit(max(1, -(-many.get(p, 0) // ASKED))) for p in range(router.parts)))
    spread = F.xxhash64("id")
    asked = asks.select(
        "id", "vector", "part", F.pmod(spread, F.get(chunks, "part")).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.get(blocks, "part") - 1)).alias("block"),
    )
    offered = filed.select(
        "id", "vector", "part", F.explode(F.sequence(F.lit(0), F.get(chunks, "part") - 1)).alias("chunk"),
        F.pmod(spread, F.get(blocks, "part")).cast("int").alias("block"),
    )
    keys = ["part", "block", "chunk"]
    met = asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInArrow(_ranked(count), "query long, item long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "item")
    ranked = met.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return ranked.select(F.col("query").alias("query_id"), "rank", F.col("item").alias(id_column), "score")
