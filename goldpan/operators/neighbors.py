"""k-nearest-neighbour joins without a cross join: an exact one, and one by hashing.

``knn_join`` is exact.  Every vector is assigned to its nearest pivot.  Triangle inequalities on the pivot distances give, for each cell of
query vectors, an upper bound on the k-th neighbour distance and from it the shells of reference vectors that can
still matter.  Neighbouring cells of queries make a block of bounded size, a vector is sent once to every block that needs it, and each
pair of blocks returns its k best per query.  There a matrix product tells which pairs can matter; only they are measured.  Equal vectors
are one vector with its k+1 smallest ids, so a large group of copies costs one vector, and the answer stays exact.

``hashed_knn_join`` compares a query only with the cells it falls into, or nearly falls into, in several hash tables.  Cells are
compared in blocks, and a vector is sent once to every block it has to do with.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldpan.operators.ordering import top_per_group
from goldpan.session import materialize

MAX_PIVOTS = 1024  # default of a parameter: distances between pivots are a matrix of pivots x pivots
BLOCK_ROWS = 32768
LEAST_ROWS = 2048  # blocks are no smaller, unless asked for, so that small tables are not cut to pieces
FIRST_ROWS = 1024  # reference vectors that give a query its first bound
Join = Callable[..., DataFrame]  # a join with the arguments of ``knn_join``
SLACK = 1e-8  # room for rounding in the pruning bounds; wider than the rounding of distances


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance matrix, computed by differences in slices: no cancellation, bounded memory."""
    out = np.empty((len(a), len(b)))
    step = max(1, 2_000_000 // max(1, b.size))
    for i in range(0, len(a), step):
        d = a[i:i + step, None, :] - b[None, :, :]
        out[i:i + step] = np.sqrt(np.einsum("ijk,ijk->ij", d, d))
    return out


def _pack(x: np.ndarray) -> list[bytes]:
    """Vectors as bytes: in single precision where that loses nothing, which halves what is shuffled."""
    single = x.astype("f4")
    exact = (single == x).all(axis=1)
    return [(single[i] if e else x[i]).tobytes() for i, e in enumerate(exact.tolist())]


def _unpack(packed: pd.Series, d: int) -> np.ndarray:
    if (packed.str.len() == 4 * d).all():
        return np.frombuffer(b"".join(packed), "f4").reshape(len(packed), d).astype(float)
    return np.array([np.frombuffer(b, "f4" if len(b) == 4 * d else "f8") for b in packed], dtype=float).reshape(len(packed), d)


def _stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float)


def _assigned(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A nearest pivot of every vector, up to rounding, and the distance to it."""
    middle = pivots.mean(axis=0)
    at = pivots - middle
    cell = np.empty(len(x), dtype=int)
    step = max(1, 4_000_000 // len(at))
    for i in range(0, len(x), step):
        cell[i:i + step] = ((at**2).sum(axis=1) - 2 * (x[i:i + step] - middle) @ at.T).argmin(axis=1)
    away = x - pivots[cell]
    return cell, np.sqrt(np.einsum("ij,ij->i", away, away))


def _assign(df: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds ``cell`` and ``to_pivot`` for the vector column ``v``."""

    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch) == 0:
                yield pd.DataFrame({"cell": pd.Series(dtype="int32"), "to_pivot": pd.Series(dtype="float64")})
                continue
            cell, away = _assigned(_stacked(batch), pivots)
            yield pd.DataFrame({"cell": cell.astype("int32"), "to_pivot": away})

    assign = F.pandas_udf(nearest, "cell int, to_pivot double")
    return df.withColumn("_a", assign("v")).select("*", "_a.cell", "_a.to_pivot").drop("_a")


def _in_order(pivots: np.ndarray, cells: list[int]) -> list[int]:
    """Cells in an order in which neighbours are close: halved along the widest axis, again and again."""
    if len(cells) <= 2:
        return cells
    axis = int(np.ptp(pivots[cells], axis=0).argmax())
    by_axis = sorted(cells, key=lambda c: pivots[c, axis])
    half = len(cells) // 2
    return _in_order(pivots, by_axis[:half]) + _in_order(pivots, by_axis[half:])


def _blocks_of(cells: list[int], sizes: dict[int, int], block_rows: int) -> tuple[dict[int, tuple[int, int]], int]:
    """First block and number of blocks of every cell, and the number of all: cells share a block, a large one is cut into several."""
    blocks: dict[int, tuple[int, int]] = {}
    block, filled = 0, 0
    for c in cells:
        if filled and filled + sizes[c] > block_rows:
            block, filled = block + 1, 0
        parts = -(-sizes[c] // block_rows)
        blocks[c] = (block, parts)
        if parts > 1:
            block += parts
        else:
            filled += sizes[c]
    return blocks, block + (filled > 0)


def _shells(between: np.ndarray, radius: dict[int, float], ref_radius: dict[int, float], nearest: dict[int, np.ndarray], blocks: dict, n_blocks: int,
            k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per block of queries and cell the range of pivot distances a reference vector must have to matter to one of its cells."""
    low, high = np.full((n_blocks, len(between)), np.inf), np.full((n_blocks, len(between)), -np.inf)
    held = list(ref_radius)
    widest = np.array([ref_radius[j] for j in held])
    for i, r in radius.items():
        bounds = np.concatenate([r + between[i, j] + ds for j, ds in nearest.items()])
        theta = float(np.partition(bounds, k - 1)[k - 1]) if len(bounds) >= k else np.inf
        reach = r + theta + SLACK * (1.0 + (theta if np.isfinite(theta) else 0.0))
        near = [j for j, w in zip(held, widest, strict=True) if between[i, j] - reach <= w]
        first, parts = blocks[i]
        for block in range(first, first + parts):
            low[block, near] = np.minimum(low[block, near], between[i, near] - reach)
            high[block, near] = np.maximum(high[block, near], between[i, near] + reach)
    return low, high


def _close(q: np.ndarray, r: np.ndarray, depth: int, reach: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) among which are the ``depth`` nearest rows of ``r`` for every row of ``q``, ties included; in pieces of bounded size.

    ``reach`` is a bound of each query's distance to the last of them and is lowered in place.  Squares come from one matrix product; its
    rounding error is part of every bound, so no pair is lost, and the caller measures the few that are left by differences.
    """
    middle = r.mean(axis=0)
    a, b = q - middle, r - middle
    aa, bb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    error = 8 * (a.shape[1] + 8) * np.finfo(float).eps * (aa.max()**0.5 + bb.max()**0.5)**2
    left, right = np.hstack([a, np.ones((len(a), 1))]), np.vstack([-2 * b.T, bb])
    first, step = min(len(r), max(FIRST_ROWS, depth)), max(1, 4_000_000 // len(r))
    comparable = np.isfinite(error)  # else every pair is measured
    for at in range(0, len(q), step):
        part = slice(at, at + step)
        squares = left[part] @ right  # without the part that is the same for all rows of r
        if comparable and len(r) >= depth:
            last = np.partition(squares[:, :first], depth - 1, axis=1)[:, depth - 1]
            reach[part] = np.minimum(reach[part], np.sqrt(np.maximum(last + aa[part] + error, 0.0)))
        bound = (reach[part] * (1 + 1e-12) + 2e-9)**2 + error - aa[part]  # distances are compared after rounding to 9 places
        i, j = np.nonzero(squares <= bound[:, None]) if comparable else np.indices(squares.shape).reshape(2, -1)
        yield i + at, j


def _measured(q: np.ndarray, r: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of pairs by differences; rounding before the comparison makes ties independent of the order of additions."""
    out = np.empty(len(i))
    step = max(1, 2_000_000 // max(1, q.shape[1]))
    for at in range(0, len(i), step):
        d = q[i[at:at + step]] - r[j[at:at + step]]
        out[at:at + step] = np.sqrt(np.einsum("ij,ij->i", d, d))
    return np.round(out, 9)


class _Best:
    """The ``depth`` best (distance, id) of every query.  Pairs come in pieces; a reference vector stands for all its ids."""

    def __init__(self, qids: np.ndarray, ids: pd.Series, depth: int, once: bool = False) -> None:
        self.qids, self.depth, self.once = qids, depth, once  # once: an id counts once, even if it was given several times
        self.counts = (ids.str.len() // 8).to_numpy().astype(int)
        self.ids = np.frombuffer(b"".join(ids), "i8")
        self.starts = np.cumsum(self.counts) - self.counts
        self.kept = (np.empty(0, dtype=int), np.empty(0), np.empty(0, dtype="i8"))
        self.waiting: list[tuple] = []
        self.size = 0

    def add(self, i: np.ndarray, j: np.ndarray, distance: np.ndarray) -> None:
        n = self.counts[j]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.waiting.append((np.repeat(i, n), np.repeat(distance, n), self.ids[np.repeat(self.starts[j], n) + within]))
        self.size += int(n.sum())
        if self.size > 4_000_000:
            self._cut()

    def _cut(self) -> None:
        i, d, rid = (np.concatenate(c) for c in zip(self.kept, *self.waiting, strict=True))
        order = np.lexsort((rid, d, i))
        i, d, rid = i[order], d[order], rid[order]
        if self.once and len(i):
            new = np.append(True, (i[1:] != i[:-1]) | (rid[1:] != rid[:-1]) | (d[1:] != d[:-1]))
            i, d, rid = i[new], d[new], rid[new]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        self.kept = tuple(c[place < self.depth] for c in (i, d, rid))
        self.waiting, self.size = [], 0

    def frame(self) -> pd.DataFrame:
        self._cut()
        i, d, rid = self.kept
        return pd.DataFrame({"qid": self.qids[i], "rid": rid, "distance": d})


FOUND = "qid long, rid long, distance double"
NOTHING = pd.DataFrame({"qid": pd.Series(dtype="int64"), "rid": pd.Series(dtype="int64"), "distance": pd.Series(dtype="float64")})


def _pruned(depth: int, between: np.ndarray, d: int):
    """Compares a block of queries with a block of reference vectors, cell by cell of the queries.

    The vectors of the nearest cells give a first bound of the distances; with it triangle inequalities leave out most of the others.
    """

    def best(key, q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if q.empty or r.empty:
            return NOTHING
        r = r.sort_values("cell", kind="stable")
        x, y = _unpack(q["v"], d), _unpack(r["v"], d)
        q_cell, r_cell, to_pivot = q["cell"].to_numpy(), r["cell"].to_numpy(), r["to_pivot"].to_numpy()
        found = _Best(q["qid"].to_numpy(), r["ids"], depth)
        held, starts, sizes = np.unique(r_cell, return_index=True, return_counts=True)
        for c in np.unique(q_cell):
            mine = np.flatnonzero(q_cell == c)
            order = np.argsort(between[c, held], kind="stable")
            upto = int(np.searchsorted(np.cumsum(sizes[order]), max(FIRST_ROWS, depth))) + 1
            near = np.concatenate([np.arange(starts[o], starts[o] + sizes[o]) for o in order[:upto]])[:4 * max(FIRST_ROWS, depth)]
            reach = np.full(len(mine), np.inf)
            for _ in _close(x[mine], y[near], depth, reach):
                pass
            far = float(reach.max())
            width = float(q["to_pivot"].to_numpy()[mine].max()) + far + SLACK * (1.0 + (far if np.isfinite(far) else 0.0))
            left = np.flatnonzero(np.abs(between[c, r_cell] - to_pivot) <= width)
            for i, j in _close(x[mine], y[left], depth, reach) if len(left) else ():
                i, j = mine[i], left[j]
                found.add(i, j, _measured(x, y, i, j))
        return found.frame()

    return best


def knn_join(
    queries: DataFrame,
    refs: DataFrame,
    k: int,
    query_id: str,
    ref_id: str,
    query_vector: str,
    ref_vector: str,
    exclude_self: bool = False,
    block_rows: int = BLOCK_ROWS,
    max_pivots: int = MAX_PIVOTS,
) -> DataFrame:
    """Columns query_id, ref_id, distance, rank: the ``k`` nearest reference rows of every query row.

    Ties are broken by ``ref_id``.  With ``exclude_self`` a reference with the id of the query is left out.
    Ids are integers.
    """
    depth = k + 1 if exclude_self else k
    q_all, q, r = _distinct_vectors(queries, refs, depth, query_id, ref_id, query_vector, ref_vector)

    n_refs = r.count()
    n_pivots = int(min(max_pivots, max(1, round(n_refs**0.5 / 2))))
    drawn = r.select("v").orderBy(F.md5(F.col("rid").cast("string"))).limit(n_pivots).collect()  # bounded by max_pivots
    if not drawn:
        return _no_answers(q_all)
    pivots = np.unique(np.array([row[0] for row in drawn], dtype=float), axis=0)
    q, r = materialize(_assign(q, pivots)), materialize(_assign(r, pivots))

    # per-cell facts: at most max_pivots rows, and depth distances per cell
    def cells(df: DataFrame) -> dict:
        rows = df.groupBy("cell").agg(F.count("*"), F.max("to_pivot")).collect()
        return {row[0]: (row[1], row[2]) for row in rows}

    q_cells, r_cells = cells(q), cells(r)
    if not q_cells:
        return _no_answers(q_all)
    nearest: dict[int, list[float]] = {}
    closest = top_per_group(r.withColumn("_ids", F.size("rids")), ["cell"], [F.col("to_pivot")], depth, "_k")
    for row in closest.select("cell", "to_pivot", "_ids").collect():
        nearest.setdefault(row[0], []).extend([row[1]] * row[2])
    between = _distances(pivots, pivots)

    # cells of queries are put together into blocks, so a reference vector is sent once to all of them; one task compares at most about
    # block_rows x block_rows vectors
    n_queries = sum(n for n, _ in q_cells.values())
    blocks, n_blocks = _blocks_of(_in_order(pivots, sorted(q_cells)), {i: n for i, (n, _) in q_cells.items()},
                                  min(block_rows, max(LEAST_ROWS, -(-n_queries // 8))))
    low, high = _shells(between, {i: w for i, (_, w) in q_cells.items()}, {j: w for j, (_, w) in r_cells.items()},
                        {j: np.array(ds) for j, ds in nearest.items()}, blocks, n_blocks, depth)
    ref_sizes = np.zeros(len(pivots))
    for j, (n, _) in r_cells.items():
        ref_sizes[j] = n
    r_blocks = np.maximum(1, np.ceil((ref_sizes * (high > -np.inf)).sum(axis=1) / min(block_rows, max(LEAST_ROWS, -(-n_refs // 8))))).astype(int)
    d = pivots.shape[1]
    first, parts = np.zeros(len(pivots), dtype=int), np.ones(len(pivots), dtype=int)
    for i, (at, n) in blocks.items():
        first[i], parts[i] = at, n
    plan = queries.sparkSession.sparkContext.broadcast((low, high, r_blocks, first, parts))

    def offered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low, high, r_blocks, _, _ = plan.value
        for batch in batches:
            if not len(batch):
                continue
            cell, away = batch["cell"].to_numpy(), batch["to_pivot"].to_numpy()
            rows = pd.DataFrame({"v": _pack(_stacked(batch["v"])), "cell": cell, "to_pivot": away, "ids": [np.sort(i).astype("i8").tobytes() for i in batch["rids"]]})
            for block in range(len(low)):
                wanted = (low[block, cell] <= away) & (away <= high[block, cell])
                if wanted.any():
                    yield rows[wanted].assign(block=block, r_block=batch["hash"].to_numpy()[wanted] % r_blocks[block])

    def asking(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, _, r_blocks, first, parts = plan.value
        for batch in batches:
            if not len(batch):
                continue
            cell = batch["cell"].to_numpy()
            block = first[cell] + batch["hash"].to_numpy() % parts[cell]
            rows = pd.DataFrame({"v": _pack(_stacked(batch["v"])), "cell": cell, "to_pivot": batch["to_pivot"], "qid": batch["qid"], "block": block})
            for r_block in range(int(r_blocks[block].max())):
                yield rows[r_block < r_blocks[block]].assign(r_block=r_block)

    place = "block int, r_block int, cell int, to_pivot double, v binary"
    candidates = r.withColumn("hash", F.abs(F.hash("rid") % 2**30)).mapInPandas(offered, f"{place}, ids binary")
    asked = q.withColumn("hash", F.abs(F.hash("qid") % 2**30)).mapInPandas(asking, f"{place}, qid long")
    block = ["block", "r_block"]
    partial = asked.groupBy(*block).cogroup(candidates.groupBy(*block)).applyInPandas(_pruned(depth, between, d), FOUND)
    found = top_per_group(partial, ["qid"], [F.col("distance"), F.col("rid")], depth, "_rank")
    return _answers(found, q, q_all, k, exclude_self)


def _distinct_vectors(queries: DataFrame, refs: DataFrame, depth: int, query_id: str, ref_id: str, query_vector: str,
                      ref_vector: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All queries, their distinct vectors (under the smallest id), and every reference vector with its ``depth`` smallest ids."""
    q_all = queries.select(F.col(query_id).cast("long").alias("qid"), F.col(query_vector).cast("array<double>").alias("v"))
    r_all = refs.select(F.col(ref_id).cast("long").alias("rid"), F.col(ref_vector).cast("array<double>").alias("v"))
    q = materialize(q_all.groupBy("v").agg(F.min("qid").alias("qid")))
    copies = top_per_group(r_all, ["v"], [F.col("rid")], depth, "_copy")
    r = materialize(copies.groupBy("v").agg(F.min("rid").alias("rid"), F.collect_list("rid").alias("rids")))
    return q_all, q, r


def _no_answers(q_all: DataFrame) -> DataFrame:
    return q_all.select(F.col("qid").alias("query_id"), F.lit(None).cast("long").alias("ref_id"),
                        F.lit(None).cast("double").alias("distance"), F.lit(None).cast("int").alias("rank")).limit(0)


def _answers(found: DataFrame, q: DataFrame, q_all: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """The ranked finds of every distinct query vector, handed to every query with that vector."""
    # one list of at most k+1 entries per distinct vector, handed to every copy of it
    lists = found.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("_rank", "rid", "distance"))).alias("found"))
    by_vector = q.select("qid", "v").join(lists, "qid").drop("qid")
    answers = q_all.join(by_vector, "v").select("qid", "found")
    if exclude_self:
        answers = answers.withColumn("found", F.filter("found", lambda e: e["rid"] != F.col("qid")))
    answers = answers.select("qid", F.posexplode(F.slice("found", 1, k)).alias("_pos", "e"))
    return answers.select(
        F.col("qid").alias("query_id"), F.col("e.rid").alias("ref_id"), F.col("e.distance").alias("distance"),
        (F.col("_pos") + 1).alias("rank"))


# ---------------------------------------------------------------- by hashing


@dataclass(frozen=True)
class Hashing:
    """Settings of ``hashed_knn_join``: more ``tables`` and ``probes`` find more and cost more."""

    tables: int = 8
    probes: int = 24  # cells a query visits in each table besides its own
    cell_rows: int = 512  # reference rows a cell should have
    slabs: int = 16  # parts into which a hot cell is cut again
    sample_rows: int = 4096
    seed: int = 42


@dataclass(frozen=True)
class _Tables:
    """One bit per random direction, cut at the median of a sample; one more direction per table for hot cells."""

    directions: np.ndarray  # tables x bits x dimensions
    medians: np.ndarray  # tables x bits
    further: np.ndarray  # tables x dimensions

    @classmethod
    def draw(cls, sample: np.ndarray, bits: int, s: Hashing) -> _Tables:
        rng = np.random.default_rng(s.seed)
        directions = rng.standard_normal((s.tables, bits, sample.shape[1]))
        further = rng.standard_normal((s.tables, sample.shape[1]))
        return cls(directions, np.median(np.einsum("nd,tbd->tbn", sample, directions), axis=2), further)

    def margins(self, table: int, x: np.ndarray) -> np.ndarray:
        return x @ self.directions[table].T - self.medians[table]

    @staticmethod
    def cells(margins: np.ndarray) -> np.ndarray:
        return (margins >= 0) @ (np.int64(1) << np.arange(margins.shape[1], dtype=np.int64))

    @staticmethod
    def probed(margins: np.ndarray, cells: np.ndarray, probes: int) -> np.ndarray:
        """Every query's own cell and the ``probes`` cells reached across the nearest cuts."""
        bits = min(10, margins.shape[1])
        near = np.argsort(np.abs(margins), axis=1)[:, :bits]
        cost = np.take_along_axis(margins, near, axis=1) ** 2
        sets = [c for size in range(1, min(bits, 4) + 1) for c in combinations(range(bits), size)]
        if not sets:
            return cells[:, None]
        member = np.array([[b in c for b in range(bits)] for c in sets])
        best = np.argsort(cost @ member.T, axis=1, kind="stable")[:, :probes]
        flips = np.einsum("qpb,qb->qp", member[best].astype(np.int64), np.int64(1) << near.astype(np.int64))
        return np.concatenate([cells[:, None], cells[:, None] ^ flips], axis=1)


def _parts(asked: np.ndarray, held: np.ndarray, borders: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the queries and of the rows of every part of a cell; a query visits its own part and the one across the nearer border."""
    if not len(borders):
        yield np.arange(len(asked)), np.arange(len(held))
        return
    own = np.searchsorted(borders, asked, side="right")
    edges = np.concatenate([[-np.inf], borders, [np.inf]])
    second = np.where(asked - edges[own] < edges[own + 1] - asked, own - 1, own + 1)
    of_rows = np.searchsorted(borders, held, side="right")
    for part in range(len(borders) + 1):
        yield np.flatnonzero((own == part) | (second == part)), np.flatnonzero(of_rows == part)


def hashed_knn_join(
    queries: DataFrame,
    refs: DataFrame,
    k: int,
    query_id: str,
    ref_id: str,
    query_vector: str,
    ref_vector: str,
    exclude_self: bool = False,
    block_rows: int = BLOCK_ROWS,
    settings: Hashing = Hashing(),
) -> DataFrame:
    """As ``knn_join``, but a query is compared only with the reference rows of the cells it visits.

    Distances are exact; neighbours in other cells are missed, and a query whose cells hold fewer than k rows gets fewer.  Cells have about
    ``cell_rows`` rows, so their number grows with the rows.  A cell of several times as many is cut again, at its own quantiles along one
    more direction, and a query visits the two parts nearest to it.  Cells that share their first bits are compared in one task, so a query
    is sent there once, with the list of its cells there, and not once per cell; blocks of either side are of bounded size, also where
    a cell is large.  Every block returns its k best per query, so pairs are never shuffled.
    """
    s = settings
    depth = k + 1 if exclude_self else k
    q_all, q, r = _distinct_vectors(queries, refs, depth, query_id, ref_id, query_vector, ref_vector)
    n_refs = r.agg(F.sum(F.size("rids"))).first()[0] or 0
    drawn = r.select("v", F.explode("rids").alias("rid")).orderBy(F.md5(F.col("rid").cast("string"))).limit(s.sample_rows).collect()  # of bounded size
    if not drawn:
        return _no_answers(q_all)
    bits = min(60, max(0, int(np.ceil(np.log2(n_refs / s.cell_rows)))))
    context = queries.sparkSession.sparkContext
    sample = np.array([row[0] for row in drawn], dtype=float)
    tables, d = context.broadcast(_Tables.draw(sample, bits, s)), sample.shape[1]
    shift = bits - min(bits, max(0, int(np.ceil(np.log2(n_refs / block_rows)))))  # a block holds the cells with the same first bits

    def cells_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _stacked(batch["v"]) if len(batch) else np.empty((0, 1))
            for t in range(s.tables if len(batch) else 0):
                rows = pd.DataFrame({"table": t, "cell": _Tables.cells(tables.value.margins(t, x)), "along": x @ tables.value.further[t]})
                yield rows.loc[rows.index.repeat(batch["copies"].to_numpy())]

    held = r.select("v", F.size("rids").alias("copies")).mapInPandas(cells_of, "table int, cell long, along double")
    parts = F.least(F.ceil(F.col("n") / F.lit(s.cell_rows)), F.lit(s.slabs)).cast("int")
    fractions = [i / s.slabs for i in range(1, s.slabs)]
    cells = materialize(held.groupBy("table", "cell").agg(F.count("*").alias("n"), F.percentile_approx("along", fractions, 1000).alias("q")))
    hot = cells.where(F.col("n") > 2 * s.cell_rows).withColumn("parts", parts).select(
        "table", "cell", F.transform(F.sequence(F.lit(1), F.col("parts") - 1),
                                     lambda i: F.get("q", (i * s.slabs / F.col("parts")).cast("int") - 1)).alias("borders"))
    # borders of the parts of hot cells: one row per 2 * cell_rows rows and table at most, some hundredth of the vectors' size
    borders = context.broadcast({(row["table"], row["cell"]): np.array(row["borders"]) for row in hot.collect()})

    def visited(t: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells every query visits in a table, and their blocks, both in the order of the blocks."""
        margins = tables.value.margins(t, x)
        cells = np.sort(_Tables.probed(margins, _Tables.cells(margins), s.probes), axis=1)
        return cells, cells >> shift

    def met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _stacked(batch["v"]) if len(batch) else np.empty((0, 1))
            for t in range(s.tables if len(batch) else 0):
                _, blocks = visited(t, x)
                first = np.hstack([np.ones((len(x), 1), dtype=bool), blocks[:, 1:] != blocks[:, :-1]])
                block, n = np.unique(blocks[first], return_counts=True)
                yield pd.DataFrame({"table": t, "block": block, "n": n})

    def blocks_needed(df: DataFrame) -> dict[tuple[int, int], int]:
        """Per table and block, of which there is one per ``block_rows`` rows of a table."""
        counted = df.groupBy("table", "block").agg(F.ceil(F.sum("n") / F.lit(block_rows)).alias("blocks"))
        return {(row["table"], row["block"]): row["blocks"] for row in counted.collect()}

    r_blocks = blocks_needed(cells.select("table", F.shiftright("cell", shift).alias("block"), "n"))
    q_blocks = blocks_needed(q.select("v").mapInPandas(met, "table int, block long, n long"))
    needed = context.broadcast((q_blocks, r_blocks))

    def spread(rows: pd.DataFrame, table: int, own: str, other: str) -> Iterator[pd.DataFrame]:
        """Every row in one of its own blocks, and there against all blocks of the other side."""
        q_blocks, r_blocks = needed.value
        mine, others = (q_blocks, r_blocks) if own == "q_block" else (r_blocks, q_blocks)
        for block, part in rows.groupby("block"):
            part = part.assign(table=table, **{own: part["hash"] % mine.get((table, block), 1)}).drop(columns="hash")
            for i in range(others.get((table, block), 0)):  # none, if the other side has nothing there
                yield part.assign(**{other: i})

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = _stacked(batch["v"])
            rows = pd.DataFrame({"hash": batch["hash"], "v": _pack(x), "ids": [np.sort(i).astype("i8").tobytes() for i in batch["rids"]]})
            for t in range(s.tables):
                cell = _Tables.cells(tables.value.margins(t, x))
                yield from spread(rows.assign(cell=cell, block=cell >> shift), t, "r_block", "q_block")

    def visiting(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = _stacked(batch["v"])
            rows = pd.DataFrame({"hash": batch["hash"], "v": _pack(x), "qid": batch["qid"]})
            for t in range(s.tables):
                cells, blocks = visited(t, x)
                first = np.flatnonzero(np.hstack([np.ones((len(x), 1), dtype=bool), blocks[:, 1:] != blocks[:, :-1]]))
                lists = [c.tobytes() for c in np.split(cells.ravel(), first[1:])]
                yield from spread(rows.iloc[first // cells.shape[1]].assign(cells=lists, block=blocks.ravel()[first]), t, "q_block", "r_block")

    def compared(key, q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if q.empty or r.empty:
            return NOTHING
        table = int(key[0])
        x, y = _unpack(q["v"], d), _unpack(r["v"], d)
        found = _Best(q["qid"].to_numpy(), r["ids"], depth, once=True)
        asked = np.frombuffer(b"".join(q["cells"]), "i8")
        who = np.repeat(np.arange(len(q)), (q["cells"].str.len() // 8).to_numpy().astype(int))
        by_cell = np.argsort(asked, kind="stable")
        asked, who = asked[by_cell], who[by_cell]
        r_cell = r["cell"].to_numpy()
        r_order = np.argsort(r_cell, kind="stable")
        reach = np.full(len(x), np.inf)
        further = tables.value.further[table]
        for cell in np.unique(r_cell):
            theirs = r_order[slice(*np.searchsorted(r_cell[r_order], [cell, cell + 1]))]
            mine = who[slice(*np.searchsorted(asked, [cell, cell + 1]))]
            cuts = borders.value.get((table, int(cell)), np.empty(0))
            for asking, there in _parts(x[mine] @ further, y[theirs] @ further, cuts):
                a, b = mine[asking], theirs[there]
                if not (len(a) and len(b)):
                    continue
                bound = reach[a]
                for i, j in _close(x[a], y[b], depth, bound):
                    i, j = a[i], b[j]
                    found.add(i, j, _measured(x, y, i, j))
                reach[a] = bound
        return found.frame()

    place = "table int, block long, q_block int, r_block int"
    asked = q.withColumn("hash", F.abs(F.hash("qid") % 2**30)).mapInPandas(visiting, f"{place}, v binary, qid long, cells binary")
    stored = r.withColumn("hash", F.abs(F.hash("rid") % 2**30)).mapInPandas(placed, f"{place}, cell long, v binary, ids binary")
    block = ["table", "block", "q_block", "r_block"]
    partial = asked.groupBy(*block).cogroup(stored.groupBy(*block)).applyInPandas(compared, FOUND)
    # a row found in several tables has one rank
    rank = F.dense_rank().over(Window.partitionBy("qid").orderBy("distance", "rid"))
    found = partial.withColumn("_rank", rank).where(F.col("_rank") <= depth).distinct()
    return _answers(found, q, q_all, k, exclude_self)


def recall(found: DataFrame, truth: DataFrame) -> float:
    """Share of the pairs of an exact join that another join has found as well."""
    both = truth.select("query_id", "ref_id").join(found.select("query_id", "ref_id", F.lit(1).alias("_hit")), ["query_id", "ref_id"], "left")
    return both.agg(F.count("_hit") / F.count("*")).first()[0]
