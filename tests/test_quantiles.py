import numpy as np
import pytest

from goldpan.operators.quantiles import exact_quantiles

FRACTIONS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)


@pytest.mark.parametrize(("accuracy", "at_once"), [(10_000, 10_000), (50, 20), (20, 1)])
def test_equal_to_sorting(spark, accuracy, at_once):
    """A coarse sketch and a small buffer force many passes, and brackets that miss."""
    rng = np.random.default_rng(3)
    n = 3000
    columns = {"spread": rng.normal(size=n), "heavy": np.round(rng.exponential(size=n) ** 4), "halves": np.repeat([0.0, 1.0], n // 2),
               "constant": np.full(n, 7.5), "two": np.where(np.arange(n) < 3, -1e300, 1e300), "few": rng.integers(0, 4, n).astype(float)}
    rows = [tuple(float(v[i]) for v in columns.values()) + ((None if i % 3 else float(i)), None) for i in range(n)]
    names = [*columns, "gaps", "empty"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(7)
    found = exact_quantiles(df, names, FRACTIONS, accuracy, at_once)
    expected = {**columns, "gaps": np.arange(0, n, 3, dtype=float)}
    for c, values in expected.items():
        for f in FRACTIONS:
            at = f * (len(values) - 1)
            lower, upper = np.sort(values)[[int(np.floor(at)), int(np.ceil(at))]]
            assert found[c][f] == pytest.approx(lower + (upper - lower) * (at - np.floor(at)), rel=1e-12, abs=1e-12)
    assert all(np.isnan(v) for v in found["empty"].values())


def test_plan_moves_no_rows(spark):
    """Exchanges carry partial aggregates to one row; there is no sort and no exchange of rows."""
    from pyspark.sql import functions as F

    df = spark.range(1000).select(F.col("id").cast("double").alias("a"))
    assert exact_quantiles(df, ["a"], (0.5,)) == {"a": {0.5: 499.5}}
    assert exact_quantiles(df.limit(0), ["a"], (0.5,))["a"][0.5] != 0
