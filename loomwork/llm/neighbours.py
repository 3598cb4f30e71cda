"""Nearest vectors by inner product: a forest of random-projection trees.

Each tree halves the vectors by their projection on the difference of two drawn
ones, until leaves are small.  A query walks all trees at once: one queue holds
every branch not taken, nearest first, until enough vectors lie in the leaves
it reached.  Those are ranked by their exact products.

How many vectors are enough is measured, not guessed: a bounded sample of the
queries is answered exactly, and the queue runs as far as it takes to find the
stated share of these answers.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.llm.ship import importable, map_batches
from loomwork.session import stage


@dataclass(frozen=True)
class Forest:
    """Parameters.

    ``fit_rows`` and ``fit_bytes`` bound the sample on which trees are fitted,
    ``leaf_rows`` is the wanted size of a leaf, ``least_fit`` the fewest sample
    vectors a leaf is fitted on.  ``target`` is the share of true neighbours
    that ``sample`` exactly answered queries must find.  ``pilot`` vectors of the
    fit tell each query a product that its answers must reach.  A task compares blocks
    of at most ``block_rows`` vectors with ``block_queries`` queries.
    """

    trees: int = 4
    leaf_rows: int = 512
    fit_rows: int = 1 << 15
    fit_bytes: int = 16 << 20
    least_fit: int = 8
    sample: int = 128
    target: float = 0.95
    pilot: int = 1 << 13
    block_rows: int = 1 << 13
    block_queries: int = 1 << 12
    seed: int = 20240301


class Trees:
    """Fitted trees as arrays: inner nodes with direction, threshold and children.

    A child below zero is the leaf ``-1 - child``; leaves are numbered through
    all trees.
    """

    def __init__(self, sample: np.ndarray, leaf: int, trees: int, seed: int):
        draw = np.random.default_rng(seed)
        self.directions: list[np.ndarray] = []
        self.thresholds: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.roots = [self._grow(sample, np.arange(len(sample)), leaf, draw) for _ in range(trees)]
        self.directions = np.asarray(self.directions, np.float32).reshape(len(self.thresholds), sample.shape[1])
        self.thresholds = np.asarray(self.thresholds, np.float32)
        self.children = np.asarray(self.children, np.int64).reshape(len(self.thresholds), 2)

    def _grow(self, sample: np.ndarray, rows: np.ndarray, leaf: int, draw: np.random.Generator) -> int:
        if len(rows) > leaf:
            for _ in range(4):
                one, two = draw.choice(rows, 2, replace=False)
                direction = sample[one] - sample[two]
                length = np.linalg.norm(direction)
                if not length > 0:
                    continue
                direction = direction / length
                at = sample[rows] @ direction
                threshold = np.median(at).astype(np.float32)
                left = at <= threshold
                if left.all() or not left.any():
                    continue
                node = len(self.thresholds)
                self.directions.append(direction)
                self.thresholds.append(threshold)
                self.children.append([0, 0])
                self.children[node] = [
                    self._grow(sample, rows[left], leaf, draw),
                    self._grow(sample, rows[~left], leaf, draw),
                ]
                return node
        self.leaves += 1
        return -self.leaves

    def assign(self, points: np.ndarray) -> np.ndarray:
        """Leaf of every point in every tree."""
        found = np.empty((len(points), len(self.roots)), np.int32)
        for t, root in enumerate(self.roots):
            at = np.full(len(points), root, np.int64)
            moving = np.flatnonzero(at >= 0)
            while len(moving):
                node = at[moving]
                side = np.einsum("ij,ij->i", points[moving], self.directions[node]) > self.thresholds[node]
                at[moving] = self.children[node, side.astype(np.int64)]
                moving = moving[at[moving] >= 0]
            found[:, t] = -1 - at
        return found

    def visit(self, query: np.ndarray, sizes: np.ndarray, enough: float) -> list[int]:
        """Leaves by nearness, trees mixed, until ``enough`` points lie in them.

        The queue is ordered by the squared distance to the planes on whose
        other side a branch lies.
        """
        margins = (self.directions @ query - self.thresholds).tolist()
        queue = [(0.0, t, root) for t, root in enumerate(self.roots)]
        found, seen = [], 0
        while queue and seen < enough:
            far, t, node = heapq.heappop(queue)
            while node >= 0:
                margin = margins[node]
                near, other = self.children[node] if margin <= 0 else self.children[node][::-1]
                heapq.heappush(queue, (far + margin * margin, t, int(other)))
                node = int(near)
            found.append(-1 - node)
            seen += int(sizes[-1 - node])
        return found


def _numbers(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of equally long vectors as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(np.float64)


def raised(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one component more, so that all have the length of the longest.

    Among these the largest inner product with a query is the nearest point.
    """
    lengths = (vectors * vectors).sum(axis=1)
    rest = np.sqrt(np.maximum(longest * longest - lengths, 0.0))
    return np.concatenate([vectors, rest[:, None]], axis=1).astype(np.float32)


def _asked(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Queries at the same length, without anything in the added component."""
    lengths = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return np.concatenate([vectors * (longest / lengths), np.zeros((len(vectors), 1))], axis=1).astype(np.float32)


def products(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed alike wherever a pair meets."""
    return (points * query).sum(axis=1)


def _below(product: float) -> float:
    """A little less, as far as rounding may go."""
    return product - 1e-9 * max(1.0, abs(product)) if np.isfinite(product) else product


def best_of(
    points: np.ndarray, names: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray | None = None
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query, the ``k`` best names and their products, ties to the smaller name.

    What lies below a query's floor is left out.
    """
    found = []
    floors = np.full(len(queries), -np.inf) if floors is None else floors
    for start in range(0, len(queries), 64):
        rough = queries[start : start + 64] @ points.T
        for i, row in enumerate(rough):
            # A matrix product may differ in the last bits; nothing near the edge is left out.
            edge = np.partition(row, -k)[-k] if len(row) > k else -np.inf
            edge = max(edge, floors[start + i])
            close = np.flatnonzero(row >= _below(edge))
            exact = products(points[close], queries[start + i])
            order = np.lexsort((names[close], -exact))[:k]
            found.append((names[close][order], exact[order]))
    return found


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vec`` and a 128-bit key of the vector, of the rows that take part."""
    value = F.col("vec")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vec")).where(
        F.col("id").isNotNull() & value.isNotNull() & (F.size(value) > 0)
    )
    rows = rows.where(~F.exists(value, bad) & F.exists(value, lambda x: x != 0))
    return rows.withColumns({"g1": F.xxhash64("vec"), "g2": F.xxhash64(F.lit(7), "vec")})


def _share(rows: float, total: int, *key: str) -> Column:
    """About ``rows`` of ``total`` rows, the same ones in every run."""
    grain = 1 << 40
    return F.pmod(F.xxhash64(F.lit("share"), *key), F.lit(grain)) < int(min(1.0, rows / max(total, 1)) * grain)


def nearest(
    vectors: DataFrame,
    every: int = 20,
    k: int = 20,
    forest: Forest = Forest(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest found of every row whose id ``every`` divides, against all other rows.

    Equal vectors are searched once, with their ``k + 1`` smallest ids, so a
    vector that fills a third of the table is one point.  Leaves, and blocks of
    them that outgrow ``forest.block_rows``, are compared with the queries that
    reached them, each in a task of bounded size; every leaf is indexed whole.
    The sample a forest is fitted on is bounded; all rows are indexed.

    Null, zero and non-finite vectors take no part, nor do rows without an id
    and vectors of another length than most (of equally many, the longer).
    Rows repeated in id and vector count once; rows that share an id with
    different vectors are searched each, and never find one another.  An empty
    table gives no rows.

    Returns ``query_id, rank`` (from 1), ``<id_col>, score``.
    """
    spark = vectors.sparkSession
    importable(spark)
    usable = _usable(vectors, id_col, vector_col)
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    sizes = usable.groupBy(F.size("vec").alias("width")).agg(F.count(F.lit(1)).alias("n"), F.max(length).alias("longest"))
    most = sizes.orderBy(F.desc("n"), F.desc("width")).limit(1).collect()
    if not most:
        return spark.createDataFrame([], f"query_id bigint, rank int, {id_col} bigint, score double")
    width, longest = most[0].width, most[0].longest
    usable = usable.where(F.size("vec") == width)

    points = stage(_points(usable, every, k), "vectors")
    total = points.count()
    room = min(forest.fit_rows, forest.fit_bytes // (4 * (width + 1)))
    sample = points.where(_share(room, total, "g1", "g2")).select("vec").orderBy("vec").toArrow()
    sample = _numbers(sample["vec"], width)
    fitted = raised(sample, longest)
    leaf = max(forest.least_fit, round(forest.leaf_rows * len(fitted) / total))
    trees = Trees(fitted, leaf, forest.trees, forest.seed)
    shared = spark.sparkContext.broadcast((trees, width, longest))

    placed = stage(_placed(points, shared), "vector-leaves")
    counts = placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect()
    leaf_sizes = np.zeros(trees.leaves, np.int64)
    for row in counts:
        leaf_sizes[row["leaf"]] = row["count"]
    asked = placed.where("asked").select("g1", "g2", "vec")
    enough = _enough(placed, asked, k, forest, trees, leaf_sizes, width, longest)
    # Every n-th of the sample, which is bounded.
    step = max(1, -(-len(sample) // forest.pilot))
    pilot = spark.sparkContext.broadcast((sample[::step], trees.assign(fitted[::step])))
    searched = stage(_visited(asked, shared, leaf_sizes, enough, pilot, k + 1), "vector-visits")
    merged = _merged(_compared(placed, searched, k, forest, width), k)

    named = usable.where(F.col("id") % every == 0).select("g1", "g2", F.col("id").alias("query_id")).distinct()
    found = named.join(merged, ["g1", "g2"])
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    rows = found.select("query_id", F.posexplode(others).alias("_at", "_one"))
    return rows.select(
        "query_id", (F.col("_at") + 1).alias("rank"), F.col("_one.id").alias(id_col), F.col("_one.score").alias("score")
    )


def _points(usable: DataFrame, every: int, k: int) -> DataFrame:
    """Distinct vectors: ``g1, g2, vec``, their ``k + 1`` smallest ids, and whether one of them is a query."""
    vecs = usable.groupBy("g1", "g2").agg(F.first("vec").alias("vec"))
    ids = usable.groupBy("g1", "g2", "id").agg(F.first(F.col("id") % every == 0).alias("asked"))
    asked = ids.groupBy("g1", "g2").agg(F.max("asked").alias("asked"))
    smallest = F.row_number().over(Window.partitionBy("g1", "g2").orderBy("id"))
    few = ids.select("g1", "g2", "id").withColumn("_n", smallest).where(F.col("_n") <= k + 1)
    listed = few.groupBy("g1", "g2").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return vecs.join(listed, ["g1", "g2"]).join(asked, ["g1", "g2"])


def _placed(points: DataFrame, shared) -> DataFrame:
    """Points with their leaf in every tree."""

    def run(batch: pa.RecordBatch):
        trees, width, longest = shared.value
        at = trees.assign(raised(_numbers(batch.column("vec"), width), longest))
        leaves = pa.array(list(at), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([*batch.columns, leaves], names=[*batch.schema.names, "leaves"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)
    return map_batches(points, run, f"{kinds}, leaves array<int>")


def _enough(
    placed: DataFrame,
    asked: DataFrame,
    k: int,
    forest: Forest,
    trees: Trees,
    leaf_sizes: np.ndarray,
    width: int,
    longest: float,
) -> float:
    """Points to look at so that the sampled queries find the wanted share of their true neighbours."""
    spark = placed.sparkSession
    queries = asked.where(_share(forest.sample, asked.count(), "g2", "g1")).orderBy("g1", "g2").toArrow()
    if not queries.num_rows:
        return float(leaf_sizes.sum())
    vecs = _numbers(queries["vec"], width)
    keys = np.stack([queries["g1"].to_numpy(), queries["g2"].to_numpy()], axis=1)
    sent = spark.sparkContext.broadcast((vecs, keys))

    def best(batches):
        # Per task the k best of every sampled query so far.
        vecs, keys = sent.value
        scores = np.full((len(vecs), 0), 0.0)
        leaves = np.zeros((len(vecs), 0, forest.trees), np.int32)
        for batch in batches:
            if not batch.num_rows:
                continue
            new = vecs @ _numbers(batch.column("vec"), width).T
            own = (keys[:, :1] == batch.column("g1").to_numpy()) & (keys[:, 1:] == batch.column("g2").to_numpy())
            new[own] = -np.inf
            at = batch.column("leaves").flatten().to_numpy().reshape(-1, forest.trees)
            scores = np.concatenate([scores, new], axis=1)
            leaves = np.concatenate([leaves, np.broadcast_to(at, (len(vecs), *at.shape))], axis=1)
            keep = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            scores = np.take_along_axis(scores, keep, axis=1)
            leaves = np.take_along_axis(leaves, keep[:, :, None], axis=1)
        who, rank = np.nonzero(np.isfinite(scores))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(who.astype(np.int32)),
                pa.array(scores[who, rank]),
                pa.array(list(leaves[who, rank]), pa.list_(pa.int32())),
            ],
            names=["query", "score", "leaves"],
        )

    rows = placed.select("g1", "g2", "vec", "leaves").mapInArrow(best, "query int, score double, leaves array<int>")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "leaves")
    true = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).select("query", "leaves").collect()
    needed = []
    looked: dict[int, dict[int, int]] = {}
    for row in true:
        if row.query not in looked:
            order = trees.visit(_asked(vecs[row.query : row.query + 1], longest)[0], leaf_sizes, np.inf)
            before = np.cumsum([0, *leaf_sizes[order]])
            looked[row.query] = dict(zip(order, before[:-1].tolist()))
        needed.append(min(looked[row.query][leaf] for leaf in row.leaves) + 1)
    return float(np.quantile(needed, forest.target, method="higher")) if needed else float(leaf_sizes.sum())


def _visited(asked: DataFrame, shared, leaf_sizes: np.ndarray, enough: float, pilot, k: int) -> DataFrame:
    """Distinct queries with the leaves they reach, and a product that their ``k`` best reach.

    That is the ``k``-th best of the pilot vectors in these very leaves, so it
    leaves out nothing that could be among the ``k`` best there.
    """

    def run(batch: pa.RecordBatch):
        trees, width, longest = shared.value
        vecs = _numbers(batch.column("vec"), width)
        leaves = [trees.visit(q, leaf_sizes, enough) for q in _asked(vecs, longest)]
        known, known_leaves = pilot.value
        floors = np.full(len(vecs), -np.inf)
        for i, (vec, reached) in enumerate(zip(vecs, leaves)):
            inside = np.zeros(trees.leaves, bool)
            inside[reached] = True
            scores = (known @ vec)[inside[known_leaves].any(axis=1)]
            if len(scores) >= k:
                floors[i] = np.partition(scores, -k)[-k]
        found = [pa.array(leaves, pa.list_(pa.int32())), pa.array(floors)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *found], names=[*batch.schema.names, "leaves", "least"]
        )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema)
    return map_batches(asked, run, f"{kinds}, leaves array<int>, least double")


def _compared(placed: DataFrame, searched: DataFrame, k: int, forest: Forest, width: int) -> DataFrame:
    """Per query and block of a leaf, the ``k + 1`` best ids by exact product."""
    points = placed.select("vec", "ids", "g1", F.explode("leaves").alias("leaf"))
    queries = searched.select("g1", "g2", "vec", "least", F.explode("leaves").alias("leaf"))
    # One row per leaf, as many as the fitted trees have.
    sizes = points.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / forest.block_rows).cast("int").alias("p"))
    calls = queries.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / forest.block_queries).cast("int").alias("q"))
    blocks = F.broadcast(stage(sizes.join(calls, "leaf"), "vector-blocks"))

    def every_block(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    points = points.join(blocks, "leaf")
    points = points.withColumn("pb", F.pmod(F.xxhash64(F.lit("p"), "g1"), F.col("p")).cast("int")).withColumn(
        "qb", every_block("q")
    )
    queries = queries.join(blocks, "leaf")
    queries = queries.withColumn("qb", F.pmod(F.xxhash64(F.lit("q"), "g1"), F.col("q")).cast("int")).withColumn(
        "pb", every_block("p")
    )
    key = ["leaf", "pb", "qb"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"g1": right["g1"][:0], "g2": right["g2"][:0], "found": pa.array([], kind)})
        rows, counts = _numbers(left["vec"], width), np.diff(_offsets(left["ids"]))
        names = left["ids"].combine_chunks().flatten().to_numpy()
        # Copies of a vector take part with each of their ids.
        least = right["least"].to_numpy()
        best = best_of(np.repeat(rows, counts, axis=0), names, _numbers(right["vec"], width), k + 1, least)
        found = pa.array(
            [[{"score": s, "id": i} for i, s in zip(ids.tolist(), scores.tolist())] for ids, scores in best], kind
        )
        some = pa.array([len(ids) > 0 for ids, _ in best])
        return pa.table({"g1": right["g1"], "g2": right["g2"], "found": found}).filter(some)

    kind = pa.list_(pa.struct([("score", pa.float64()), ("id", pa.int64())]))
    left = points.select(*key, "vec", "ids").groupBy(*key)
    right = queries.select(*key, "g1", "g2", "vec", "least").groupBy(*key)
    schema = "g1 bigint, g2 bigint, found array<struct<score: double, id: bigint>>"
    return left.cogroup(right).applyInArrow(run, schema)


def _offsets(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().offsets.to_numpy()


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The ``k + 1`` best of each query over all leaves it reached."""
    rows = found.select("g1", "g2", F.explode("found").alias("f")).select("g1", "g2", "f.score", "f.id")
    # A pair met in several trees has one product.
    pairs = rows.groupBy("g1", "g2", "id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("g1", "g2").orderBy(F.desc("score"), "id"))
    few = pairs.withColumn("_n", place).where(F.col("_n") <= k + 1)
    return few.groupBy("g1", "g2").agg(F.array_sort(F.collect_list(F.struct("_n", "id", "score"))).alias("found"))
