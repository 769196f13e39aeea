import numpy as np
import pandas as pd
import pytest

from goldpan.operators import neighbors
from goldpan.operators.neighbors import Hashing, hashed_knn_join, knn_join, recall


def brute(queries, refs, k, exclude_self):
    out = {}
    for qid, q in queries:
        near = sorted((round(float(np.linalg.norm(np.array(q) - np.array(r))), 9), rid) for rid, r in refs if not (exclude_self and rid == qid))
        out[qid] = near[:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["distance"], r["ref_id"]))
    return out


@pytest.mark.parametrize("exclude_self", [False, True])
@pytest.mark.parametrize("shape", ["spread", "clusters", "copies"])
def test_matches_brute_force(spark, shape, exclude_self):
    rng = np.random.default_rng(5)
    if shape == "spread":
        x = rng.normal(size=(150, 3))
    elif shape == "clusters":
        x = np.concatenate([rng.normal(c, 0.1, size=(50, 2)) for c in (0, 5, 50)])
    else:  # one vector is a third of all rows, and many distances tie
        x = np.concatenate([np.zeros((50, 2)), rng.integers(0, 4, size=(100, 2)).astype(float)])
    points = [(int(i), [float(v) for v in row]) for i, row in enumerate(x)]
    df = spark.createDataFrame(points, "id long, v array<double>")
    got = found(knn_join(df, df, 4, "id", "id", "v", "v", exclude_self, block_rows=16))
    expected = brute(points, points, 4, exclude_self)
    assert got.keys() == expected.keys()
    for q in expected:
        assert [r for _, r in got[q]] == [r for _, r in expected[q]]
        assert np.allclose([d for d, _ in got[q]], [d for d, _ in expected[q]], atol=1e-8)


def test_fewer_references_than_k_and_foreign_queries(spark):
    refs = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0])], "id long, v array<double>")
    asked = spark.createDataFrame([(10, [0.0, 1.0]), (11, [100.0, 0.0])], "q long, w array<float>")
    got = found(knn_join(asked, refs, 5, "q", "id", "w", "v"))
    assert [r for _, r in got[10]] == [1, 2] and [r for _, r in got[11]] == [2, 1]
    assert knn_join(asked, refs.limit(0), 5, "q", "id", "w", "v").count() == 0


def mixture(n, seed=1, d=6):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-20, 20, size=(60, d))
    x = centres[rng.integers(0, 60, n)] + rng.normal(size=(n, d))
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


@pytest.mark.parametrize("settings", [Hashing(cell_rows=64), Hashing(tables=4, cell_rows=400, slabs=4)])
def test_hashed_join_finds_most_of_what_the_exact_one_finds(spark, settings):
    df = spark.createDataFrame(mixture(4000), "id long, v array<double>").repartition(4)
    exact = knn_join(df, df, 5, "id", "id", "v", "v", exclude_self=True).cache()
    hashed = hashed_knn_join(df, df, 5, "id", "id", "v", "v", exclude_self=True, settings=settings).cache()
    assert recall(hashed, exact) >= 0.9
    assert hashed.groupBy("query_id", "ref_id").count().where("count > 1").count() == 0
    both = hashed.join(exact.withColumnRenamed("distance", "exactly"), ["query_id", "ref_id"])
    assert both.where("abs(distance - exactly) > 1e-9").count() == 0


def test_copies_of_a_vector_do_not_depend_on_the_number_of_rows(spark):
    """What is laid against queries: every vector once per table, whether there are 1,500 or 6,000."""
    settings = Hashing(tables=5, cell_rows=64)
    for n in (1500, 6000):
        sample = np.array([v for _, v in mixture(n)])
        bits = int(np.ceil(np.log2(n / settings.cell_rows)))
        tables = neighbors._Tables.draw(sample, bits, settings)
        sizes = []
        for t in range(settings.tables):
            margins = tables.margins(t, sample)
            cells = tables.cells(margins)
            assert cells.shape == (n,)  # one cell of the table
            visited = tables.probed(margins, cells, settings.probes)
            assert visited.shape[1] <= 1 + settings.probes and (visited[:, 0] == cells).all()
            assert all(len(set(row)) == len(row) for row in visited[:50].tolist())
            sizes.append(np.bincount(cells, minlength=2**bits).mean())
        assert max(sizes) <= settings.cell_rows


def test_hot_cells_and_copies(spark):
    """Half of the rows lie in one narrow ball, a sixth are one vector: small blocks, results as by brute force in the ball."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(600, 3)) * 0.01 + 4, np.zeros((200, 3)), rng.uniform(-50, 50, size=(400, 3))])
    points = [(int(i), [float(v) for v in row]) for i, row in enumerate(x)]
    df = spark.createDataFrame(points, "id long, v array<double>").repartition(3)
    settings = Hashing(tables=6, probes=12, cell_rows=64, slabs=8)
    got = found(hashed_knn_join(df, df, 4, "id", "id", "v", "v", True, block_rows=128, settings=settings))
    expected = brute(points, points, 4, True)
    hits = sum(len({r for _, r in got.get(q, [])} & {r for _, r in expected[q]}) for q in expected)
    assert hits >= 0.9 * 4 * len(points)
    assert [r for _, r in got[700]] == [600, 601, 602, 603]
    assert hashed_knn_join(df, df.limit(0), 4, "id", "id", "v", "v").count() == 0


def test_models_take_the_join_as_an_argument(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from goldpan.models import anomaly, classifiers, regressors

    df = spark.createDataFrame(mixture(800), "row_id long, v array<double>")
    rows = df.select("row_id", array_to_vector("v").alias("features"), (F.get("v", F.lit(0)) > 0).cast("double").alias("y")).cache()
    train, test = rows.where("row_id % 4 > 0"), rows.where("row_id % 4 = 0")
    for fit in (classifiers.knn(5, join=hashed_knn_join), regressors.knn(5, join=hashed_knn_join)):
        out = fit(train)(test)
        assert out.where("abs(yhat - y) < 0.5").count() >= 190
    scores = anomaly.local_outlier_factor(df, 10, join=hashed_knn_join)
    assert scores.count() == 800 and scores.where("lof < 2").count() > 700


def test_cells_of_queries_share_blocks_and_large_cells_are_cut():
    """A vector is sent to blocks, so their number follows the rows and not the cells."""
    sizes = {c: 10 for c in range(40)} | {40: 250}
    blocks, n = neighbors._blocks_of(sorted(sizes), sizes, 100)
    assert n == 4 + 3 and blocks[40] == (4, 3)
    assert all(sum(sizes[c] for c, (b, parts) in blocks.items() if b == block and parts == 1) <= 100 for block in range(n))


@pytest.mark.parametrize("shift", [0.0, 1e4])
def test_products_lose_no_neighbour(shift):
    """Many ties and a far origin: the few pairs that are measured hold the nearest rows."""
    rng = np.random.default_rng(7)
    q, r = (rng.integers(0, 4, size=(n, 5)).astype(float) + shift for n in (60, 3000))
    reach = np.full(len(q), np.inf)
    found = neighbors._Best(np.arange(len(q)), pd.Series([np.array([i], dtype="i8").tobytes() for i in range(len(r))]), 6)
    for i, j in neighbors._close(q, r, 6, reach):
        found.add(i, j, neighbors._measured(q, r, i, j))
    out = found.frame()
    for i in range(len(q)):
        d = np.round(np.linalg.norm(q[i] - r, axis=1), 9)
        assert out.loc[out["qid"] == i, "rid"].tolist() == np.argsort(d, kind="stable")[:6].tolist()


def test_a_query_is_sent_to_a_block_once_and_not_to_every_cell(spark, monkeypatch):
    """Rows that the hashed join shuffles per query: one per table here, where it was one per table and visited cell."""
    original = neighbors._unpack
    df = spark.createDataFrame(mixture(1000), "id long, v array<double>")
    seen = spark.sparkContext.accumulator(0)

    def counting(packed, d):
        seen.add(len(packed))
        return original(packed, d)

    monkeypatch.setattr(neighbors, "_unpack", counting)
    settings = Hashing(tables=3, cell_rows=64)
    assert hashed_knn_join(df, df, 4, "id", "id", "v", "v", True, settings=settings).count() == 4000
    assert 0 < seen.value <= 2 * 3 * 1000
