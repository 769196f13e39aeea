import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from goldpan.operators import features


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    data = [(i, float(a), float(b), 7.0, float(a > 0)) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    return spark.createDataFrame(data, "id long, a double, b double, c double, y double").cache()


def vectors(df, name):
    return np.array([r[0] for r in df.orderBy("id").select(vector_to_array(name)).collect()])


def test_scalers_and_constant_columns(rows):
    a = np.array([r[0] for r in rows.select("a").collect()])
    std = features.fit_standard(rows, ["a", "c"]).transform(rows)
    got = std.agg(F.avg("a"), F.stddev_pop("a"), F.max("c"), F.min("c")).first()
    assert abs(got[0]) < 1e-9 and abs(got[1] - 1) < 1e-9 and got[2] == got[3] == 0.0
    mm = features.fit_minmax(rows, ["a", "c"]).transform(rows).agg(F.min("a"), F.max("a"), F.max("c")).first()
    assert tuple(mm) == (0.0, 1.0, 0.0)
    robust = features.fit_robust(rows, ["a", "c"])
    assert robust.centers[0] == pytest.approx(np.median(a)) and robust.widths[0] == pytest.approx(np.subtract(*np.quantile(a, [0.75, 0.25])))
    assert robust.widths[1] == 0.0


def test_rare_values_are_pooled(spark):
    df = spark.createDataFrame([("x",)] * 6 + [("y",)] * 3 + [("z",)], "k string")
    assert features.frequent_values(df, "k", 0.3) == ["x", "y"]
    coded = features.onehot_minimum_fraction(df, "k", 0.3)
    assert [tuple(r) for r in coded.agg(F.sum("is_x"), F.sum("is_y"), F.sum("is_other")).collect()] == [(6, 3, 1)]


def test_kernel_maps_approximate_the_kernel(rows):
    df = features.assemble(rows.limit(40), ["a", "b"])
    x = vectors(df, "features")
    exact = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    z = vectors(features.FourierMap.draw(2, 4000, 0.5, 1).transform(df), "rff")
    assert np.abs(z @ z.T - exact).max() < 0.1
    n = vectors(features.NystroemMap.fit(df, ["id"], 40, 0.5).transform(df), "nystroem")
    assert np.abs(n @ n.T - exact).max() < 1e-3


def test_other_stages(rows):
    df = features.assemble(rows, ["a", "b", "c"])
    assert vectors(features.variance_selector(0.01).fit(df).transform(df), "selected").shape == (300, 2)
    assert vectors(features.polynomial(2).transform(df), "poly").shape == (300, 9)
    assert vectors(features.pca(2).fit(df).transform(df), "pca").shape == (300, 2)
    chosen = features.univariate_selector("percentile", 0.4, categorical_label=True).fit(df.drop("c")).selectedFeatures
    assert 0 in chosen
    counts = features.zero_counts(features.binarize(rows, ["a", "b"], 0.0), ["a", "b"])
    assert counts.filter("n_zero + n_nonzero <> 2").count() == 0
