"""Approximate nearest neighbours: a forest of random-projection trees searched through one shared priority queue, then exact reranking.

A tree cuts space by one of its own orthonormal directions per level, at medians, so a leaf is a box in the space of these directions and
the sum of the squared distances to the cuts that part it from a query is a lower bound of the squared distance to anything in it.  One
queue over all trees hands out leaves by this bound; how far it is followed is measured on pilot queries with known neighbours.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldpan.functions.hashing import digest
from goldpan.llm.shared import stored

_SCORES_AT_ONCE = 1 << 21
_SEARCHES_IN_TASK = 128  # walks through the queue, each some milliseconds long


@dataclass(frozen=True)
class Forest:
    """``cuts[t]`` holds the inner nodes of tree t in heap order (children of i: 2i+1, 2i+2); leaves are numbered from the left."""

    directions: list[np.ndarray]  # per tree: dimensions x depth
    cuts: list[np.ndarray]
    radius: float

    @property
    def depth(self) -> int:
        return self.directions[0].shape[1]

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """One more coordinate puts every row on the sphere of the longest one; there the largest inner product is the nearest row."""
        rest = self.radius ** 2 - np.einsum("ij,ij->i", vectors, vectors)
        return np.hstack([vectors, np.sqrt(np.maximum(rest, 0.0))[:, None]])

    def aimed(self, queries: np.ndarray) -> np.ndarray:
        """Queries scaled to the sphere; this changes no ranking."""
        norms = np.sqrt(np.einsum("ij,ij->i", queries, queries))[:, None]
        return np.hstack([queries * (self.radius / norms), np.zeros((len(queries), 1))])

    def leaves(self, tree: int, lifted: np.ndarray) -> np.ndarray:
        along = lifted @ self.directions[tree]
        node = np.zeros(len(lifted), np.int64)
        for level in range(self.depth):
            node = 2 * node + 1 + (along[:, level] >= self.cuts[tree][node])
        return node - (2 ** self.depth - 1)

    def bounds(self, tree: int, aimed: np.ndarray) -> np.ndarray:
        """The bound of every leaf for every query."""
        along = aimed @ self.directions[tree]
        found = np.zeros((len(aimed), 1))
        for level in range(self.depth):
            off = along[:, level, None] - self.cuts[tree][2 ** level - 1:2 ** (level + 1) - 1]
            far = off ** 2
            found = np.stack([found + np.where(off >= 0, far, 0), found + np.where(off < 0, far, 0)], axis=2).reshape(len(aimed), -1)
        return found

    def search(self, aimed: np.ndarray, reach: float, least_rows: int, rows_of: list[np.ndarray]) -> list[tuple[int, int]]:
        """(tree, leaf) by rising bound, from all trees, until the bound exceeds ``reach`` and ``least_rows`` rows are in every tree's leaves."""
        along = [(aimed @ d).tolist() for d in self.directions]
        cuts = self.cuts
        inner = 2 ** self.depth - 1
        queue = [(0.0, tree, 0, 0) for tree in range(len(cuts))]
        held = [0] * len(cuts)
        found = []
        while queue:
            bound, tree, node, level = heapq.heappop(queue)
            if bound > reach and min(held) >= least_rows:
                break
            place, cut = along[tree], cuts[tree]
            while node < inner:
                off = place[level] - cut[node]
                near = 2 * node + 2 if off >= 0 else 2 * node + 1
                heapq.heappush(queue, (bound + off * off, tree, 4 * node + 3 - near, level + 1))
                node, level = near, level + 1
            held[tree] += rows_of[tree][node - inner]
            found.append((tree, node - inner))
        return found


def grow(sample: np.ndarray, radius: float, rows: int, trees: int, leaf_rows: int, seed: int) -> Forest:
    """Cuts at the medians of the sample.  Trees get a level per doubling of the rows beyond ``leaf_rows``, as long as leaves hold sample rows."""
    dims = sample.shape[1] + 1
    depth = 0
    while leaf_rows << depth < rows and 16 << depth <= len(sample) and depth < dims:
        depth += 1
    rng = np.random.default_rng(seed)
    forest = Forest([], [], radius)
    lifted = forest.lifted(sample)
    for _ in range(trees):
        directions = np.linalg.qr(rng.standard_normal((dims, max(depth, 1))))[0][:, :depth]
        along = lifted @ directions
        node, cuts = np.zeros(len(lifted), np.int64), np.zeros(2 ** depth - 1)
        for level in range(depth):
            order = np.lexsort((along[:, level], node))
            names = np.arange(2 ** level - 1, 2 ** (level + 1) - 1)
            low, high = np.searchsorted(node[order], names), np.searchsorted(node[order], names, side="right")
            middle = along[order[np.minimum((low + high) // 2, len(order) - 1)], level]
            cuts[names] = np.where(high > low, middle, 0.0)
            node = 2 * node + 1 + (along[:, level] >= cuts[node])
        forest.directions.append(directions)
        forest.cuts.append(cuts)
    return forest


@dataclass(frozen=True)
class Shards:
    """Neighbouring leaves are searched together, in shards of about ``rows`` rows; a leaf of more rows has several shards of its own.

    A shard hands on k + 1 rows per query, however many of its leaves the query visits, so large shards keep that small.
    """

    first: list[np.ndarray]  # per tree and leaf
    count: list[np.ndarray]

    @classmethod
    def of(cls, rows_of: list[np.ndarray], rows: int) -> Shards:
        firsts, counts = [], []
        for sizes in rows_of:
            first, count = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
            shard, held = 0, 0
            for leaf, size in enumerate(sizes.tolist()):
                if held and held + size > rows:
                    shard, held = shard + 1, 0
                first[leaf], count[leaf] = shard, max(1, -(-size // rows))
                held += size
                if count[leaf] > 1:
                    shard, held = shard + int(count[leaf]), 0
            firsts.append(first)
            counts.append(count)
        return cls(firsts, counts)


def _matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    """Rows of doubles; shorter vectors end in zeros."""
    if len(vectors) and all(len(v) == dims for v in vectors):
        return np.stack(vectors.to_numpy()).astype(np.float64)
    out = np.zeros((len(vectors), dims))
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return out


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _best_of(rows: np.ndarray, lows: np.ndarray, queries: np.ndarray, allowed: np.ndarray | None, k: int) -> tuple[np.ndarray, ...]:
    """Positions of queries, positions of their ``k`` best rows and the scores, summed dimension after dimension as a loop would.

    Ties go to the row with the smaller entry of ``lows``.
    """
    rough = queries @ rows.T
    if allowed is not None:
        rough[~allowed] = -np.inf
    more = min(k + 4, rows.shape[0])  # the fast product may order rows differently that differ in the last digits
    at = np.argpartition(-rough, more - 1, axis=1)[:, :more] if more < rows.shape[0] else np.tile(np.arange(more), (len(queries), 1))
    exact = np.zeros(at.shape)
    for d in range(rows.shape[1]):
        exact += rows[at, d] * queries[:, d, None]
    exact[np.isinf(np.take_along_axis(rough, at, axis=1))] = -np.inf
    order = np.lexsort((lows[at], -exact), axis=1)[:, :k]
    scores = np.take_along_axis(exact, order, axis=1)
    at = np.take_along_axis(at, order, axis=1)
    good = ~np.isinf(scores)
    return np.nonzero(good)[0], at[good], scores[good]


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
                       trees: int = 4, leaf_rows: int = 64, sample_rows: int = 16_384, pilots: int = 64, target: float = 0.95,
                       shard_rows: int = 65_536, block_rows: int = 2048, seed: int = 11) -> DataFrame:
    """query_id, rank, id and score (inner product in double precision) of the ``k`` nearest rows found for every query.

    Cuts are fitted on ``sample_rows`` vectors drawn by digest; every vector is then put into one leaf of each tree.  ``pilots`` queries
    are also answered exactly by one pass over all vectors, and the queue is followed as far as ``target`` of their neighbours need.
    All rows of a visited leaf are scored, however many there are.

    Equal vectors are indexed once, with their k + 1 smallest ids, more of which no result can hold.  Vectors that are null, zero, empty
    or hold null or non-finite components take no part, nor do null ids.  Shorter vectors count as padded with zeros.  A repeated row
    counts once; an id repeated with different vectors is a candidate with each and, as a query, is asked with each.  An empty table, or one
    without queries, gives no rows.  Only the two named columns are read.
    """
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
        return rows.where(F.col("id").isNotNull() & _usable(F.col("v")))

    # the window drops all but the smallest ids in the map tasks, so a vector that a third of the rows have is no large group
    place = F.dense_rank().over(Window.partitionBy("v").orderBy("id"))
    own = usable(vectors).withColumn("place", place).where(F.col("place") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    points = stored(own.select(F.monotonically_increasing_id().alias("point"), "v", "ids", norm.alias("norm")), "points")
    asked = usable(queries).distinct()
    goals = stored(asked.select("v").distinct().select(F.monotonically_increasing_id().alias("goal"), "v"), "goals")
    rows, longest, dims = points.agg(F.count(F.lit(1)), F.max("norm"), F.max(F.size("v"))).first()
    n_goals, most = goals.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    empty = spark.createDataFrame([], f"query_id long, rank int, {id_column} long, score double")
    if not rows or most is None:
        return empty
    dims = max(dims, most)

    drawn = points.orderBy(digest(seed, ["point"]), "point").limit(sample_rows).select("v").toPandas()["v"]  # of bounded size
    forest = grow(_matrix(drawn, dims), float(np.sqrt(longest)), rows, trees, leaf_rows, seed)
    shared = spark.sparkContext.broadcast(forest)  # at most sample_rows / 8 cuts a tree
    n_leaves = 2 ** forest.depth

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((trees, n_leaves), np.int64)
        for batch in batches:
            lifted = shared.value.lifted(_matrix(batch["v"], dims))
            for tree in range(trees):
                totals[tree] += np.bincount(shared.value.leaves(tree, lifted), minlength=n_leaves)
        tree, leaf = np.nonzero(totals)
        yield pd.DataFrame({"tree": tree, "leaf": leaf, "n": totals[tree, leaf]})

    sizes = points.select("v").mapInPandas(counted, "tree int, leaf int, n long").groupBy("tree", "leaf").agg(F.sum("n").alias("n")).toPandas()
    rows_of = [np.zeros(n_leaves, np.int64) for _ in range(trees)]
    for tree, leaf, n in zip(sizes["tree"], sizes["leaf"], sizes["n"], strict=True):
        rows_of[tree][leaf] = n
    shards = Shards.of(rows_of, shard_rows)

    reach = _measured_reach(points, goals, shared, dims, k, pilots, target, seed)

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            aimed = shared.value.aimed(_matrix(batch["v"], dims))
            for goal, v, q in zip(batch["goal"], batch["v"], aimed, strict=True):
                per_shard: dict[tuple[int, int], list[int]] = {}
                for tree, leaf in shared.value.search(q, reach, k + 1, rows_of):
                    first = int(shards.first[tree][leaf])
                    for shard in range(first, first + int(shards.count[tree][leaf])):
                        per_shard.setdefault((tree, shard), []).append(leaf)
                found += [(goal, v, tree, shard, leaves) for (tree, shard), leaves in per_shard.items()]
            yield pd.DataFrame(found, columns=["goal", "v", "tree", "shard", "leaves"])

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lifted = shared.value.lifted(_matrix(batch["v"], dims))
            for tree in range(trees):
                leaf = shared.value.leaves(tree, lifted)
                # rows of a leaf with several shards are spread by their number
                shard = shards.first[tree][leaf] + batch["point"].to_numpy() % shards.count[tree][leaf]
                yield pd.DataFrame({"tree": tree, "shard": shard, "leaf": leaf, "point": batch["point"], "low": batch["low"], "v": batch["v"]})

    dealt = goals.repartition(-(-n_goals // _SEARCHES_IN_TASK), "goal")
    wanted = stored(dealt.mapInPandas(visits, "goal long, v array<double>, tree int, shard long, leaves array<int>"), "visits")
    # a shard meets its queries in blocks, so a task holds a bounded number of either
    blocks = stored(wanted.groupBy("tree", "shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("blocks")), "blocks")
    left = (
        points.select("point", F.col("ids")[0].alias("low"), "v")
        .mapInPandas(placed, "tree int, shard long, leaf int, point long, low long, v array<double>").join(blocks, ["tree", "shard"])
        .select("tree", "shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "leaf", "point", "low", "v"))
    right = wanted.join(blocks.select("tree", "shard", F.col("blocks").alias("of")), ["tree", "shard"]).select(
        "tree", "shard", F.pmod(F.xxhash64("goal"), F.col("of")).cast("int").alias("block"), "goal", "leaves", "v")

    def searched(here: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(here) and len(asking):
            matrix, names, lows = _matrix(here["v"], dims), here["point"].to_numpy(), here["low"].to_numpy()
            leaf_names, leaf_at = np.unique(here["leaf"].to_numpy(), return_inverse=True)
            step = max(1, _SCORES_AT_ONCE // len(here))
            for low in range(0, len(asking), step):
                some = asking.iloc[low:low + step]
                allowed = np.zeros((len(some), len(leaf_names)), bool)
                for j, leaves in enumerate(some["leaves"]):
                    allowed[j] = np.isin(leaf_names, leaves)
                at, found, scores = _best_of(matrix, lows, _matrix(some["v"], dims), allowed[:, leaf_at], k + 1)
                parts.append(pd.DataFrame({"goal": some["goal"].to_numpy()[at], "point": names[found], "low": lows[found], "score": scores}))
        return pd.concat(parts) if parts else pd.DataFrame({"goal": [], "point": [], "low": [], "score": []})

    met = left.groupBy("tree", "shard", "block").cogroup(right.groupBy("tree", "shard", "block")).applyInPandas(
        searched, "goal long, point long, low long, score double")
    # a row found through several trees has one rank; no more than k + 1 different vectors can matter
    rank = F.dense_rank().over(Window.partitionBy("goal").orderBy(F.col("score").desc(), "low", "point"))
    best = stored(met.withColumn("r", rank).where(F.col("r") <= k + 1).select("goal", "point", "score").distinct(), "best")
    named = best.join(points.select("point", "ids"), "point").select("goal", "score", F.explode("ids").alias("id"))
    listed = named.withColumn("n", F.row_number().over(Window.partitionBy("goal").orderBy(F.col("score").desc(), "id"))).where(F.col("n") <= k + 1)
    results = listed.groupBy("goal").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("found"))
    of_query = asked.join(goals, "v").select(F.col("id").alias("query_id"), "goal").join(results, "goal")
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    return of_query.select("query_id", F.posexplode(others).alias("pos", "x")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("x.id").alias(id_column), F.col("x.score").alias("score"))


def _measured_reach(points: DataFrame, goals: DataFrame, shared, dims: int, k: int, pilots: int, target: float, seed: int) -> float:
    """The bound up to which leaves hold ``target`` of the true neighbours of the pilot queries."""
    drawn = goals.orderBy(digest(seed, ["goal"]), "goal").limit(pilots).select("v").toPandas()["v"]
    exact = _matrix(drawn, dims)
    forest = shared.value
    bounds = [forest.bounds(tree, forest.aimed(exact)) for tree in range(len(forest.cuts))]

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = _matrix(batch["v"], dims)
            lifted = shared.value.lifted(rows)
            nearest = np.min([b[:, shared.value.leaves(tree, lifted)] for tree, b in enumerate(bounds)], axis=0)
            at, found, scores = _best_of(rows, np.arange(len(rows)), exact, None, k + 1)
            yield pd.DataFrame({"pilot": at, "score": scores, "bound": nearest[at, found]})

    rank = F.row_number().over(Window.partitionBy("pilot").orderBy(F.col("score").desc(), "bound"))
    truth = points.select("v").mapInPandas(scanned, "pilot int, score double, bound double").withColumn("r", rank).where(F.col("r").between(2, k + 1))
    needed = np.sort(truth.select("bound").toPandas()["bound"].to_numpy())  # pilots x k at most; a pilot itself is the first
    return float(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))))]) if len(needed) else 0.0
