"""Exact top-k search by integer inner product with block-at-a-time pruning.

Vectors lie in blocks of neighbouring documents.  For every query the blocks of a range are ordered by the sum, over the dimensions, of
the largest product the block can give; they are scored through their forward indexes (the vectors of the block, dimension by
dimension) until no block left can reach the k-th score found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldpan.functions.hashing import digest
from goldpan.llm.shared import stored


def quantised(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component, with x as a double; null if the vector or a component is null or not finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(good, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


class BlockIndex:
    """The vectors of one range in blocks, with the smallest and largest value of every dimension in each block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, block: int) -> None:
        # neighbours by direction share a block, which makes its maxima tight; the order has no influence on results
        order = np.argsort(_direction(vectors), kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        starts = np.arange(0, len(ids), block)
        self.starts, self.ends = starts, np.minimum(starts + block, len(ids))
        self.low = np.minimum.reduceat(self.vectors, starts, axis=0)
        self.high = np.maximum.reduceat(self.vectors, starts, axis=0)

    def search(self, own_id: int, query: np.ndarray, k: int, floor: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The k best of this range that reach ``floor``: ids and scores."""
        bounds = np.maximum(query * self.low, query * self.high).sum(axis=1)
        ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        least = floor
        for b in np.argsort(-bounds, kind="stable"):
            if least is not None and bounds[b] < least:
                break
            at = slice(self.starts[b], self.ends[b])
            s, i = self.vectors[at] @ query, self.ids[at]
            reach = i != own_id
            if least is not None:
                reach &= s >= least
            ids, scores = np.concatenate([ids, i[reach]]), np.concatenate([scores, s[reach]])
            if len(ids) > k:
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
            if len(ids) == k:
                least = int(scores.min()) if least is None else max(least, int(scores.min()))
        return ids, scores


def _direction(vectors: np.ndarray) -> np.ndarray:
    """A coarse code of the direction: signs of the strongest dimensions of the range."""
    spread = np.argsort(-vectors.astype(float).var(axis=0), kind="stable")[:12]
    return ((vectors[:, spread] > 0) * (1 << np.arange(len(spread)))).sum(axis=1)


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, id_column: str = "vec_id",
                vector_column: str = "embedding", range_rows: int = 4096, block_rows: int = 64, query_rows: int = 1024,
                sample_rows: int = 2048, seed: int = 3) -> DataFrame:
    """query_id, rank, id and score of the ``k`` highest scores of every query among all other rows.

    Vectors that are null, or hold null or non-finite components, take no part, nor do null ids; ties go to the smaller id; a repeated row is a
    candidate each time, except for queries with its own id; a query given twice is asked once.  Vectors of different lengths are compared within their length.
    Queries are laid against all rows in blocks: a pair of a block of queries and a range of vectors is one bounded task.  The k-th
    score within a bounded sample is a safe floor for every query.
    """

    def prepared(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_column).cast("long").alias("id"), quantised(F.col(vector_column), scale).alias("v")).where(
            F.col("v").isNotNull() & F.col("id").isNotNull() & (F.size("v") > 0)).withColumn("dim", F.size("v"))

    every, asked = stored(prepared(vectors), "vectors"), stored(prepared(queries).dropDuplicates(["id"]), "queries")
    n_ranges, n_query_blocks = max(1, -(-every.count() // range_rows)), max(1, -(-asked.count() // query_rows))

    drawn = every.orderBy(digest(seed, ["id"]), "id").limit(sample_rows).collect()  # of bounded size
    sample: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {r["dim"] for r in drawn}:
        own = [r for r in drawn if r["dim"] == dim]
        sample[dim] = np.array([r["id"] for r in own]), np.array([r["v"] for r in own], dtype=np.int64)

    def with_floor(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            floors = []
            for i, v, dim in zip(batch["id"], batch["v"], batch["dim"], strict=True):
                ids, rows = sample.get(dim, (np.empty(0, np.int64), np.empty((0, dim), np.int64)))
                scores = (rows @ np.asarray(v, dtype=np.int64))[ids != i]
                floors.append(int(np.partition(scores, -k)[-k]) if len(scores) >= k else None)
            batch["floor"] = pd.array(floors, dtype="Int64")
            yield batch

    # a row's range and a query's block come from its digest, so both are of even size; rows with one id spread by their content
    ranged = every.withColumn("range", F.pmod(F.xxhash64("id", "v"), F.lit(n_ranges)).cast("int"))
    blocked = asked.mapInPandas(with_floor, "id long, v array<long>, dim int, floor long").withColumn(
        "block", F.pmod(F.xxhash64("id", "v"), F.lit(n_query_blocks)).cast("int"))
    left = ranged.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1)))).groupBy("dim", "range", "block")
    right = blocked.withColumn("range", F.explode(F.sequence(F.lit(0), F.lit(n_ranges - 1)))).groupBy("dim", "range", "block")

    def searched(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(wanted):
            index = BlockIndex(rows["id"].to_numpy(), np.array(rows["v"].tolist(), dtype=np.int64), block_rows)
            for q, v, floor in zip(wanted["id"], wanted["v"], wanted["floor"], strict=True):
                ids, scores = index.search(q, np.asarray(v, dtype=np.int64), k, None if pd.isna(floor) else int(floor))
                found.append(pd.DataFrame({"query_id": q, "id": ids, "score": scores}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "id": [], "score": []}, dtype="int64")

    best = left.cogroup(right).applyInPandas(searched, "query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_column), "score")


TOP_K_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
