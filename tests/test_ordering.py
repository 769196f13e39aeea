import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from goldpan.operators.ordering import number_rows, positional_values, running_totals, top_per_group


def frame(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    groups = np.where(rng.random(n) < 0.6, "hot", rng.choice(list("abc"), n))  # one group holds most rows
    return pd.DataFrame({"g": groups, "o": rng.integers(0, 500, n), "id": np.arange(n), "v": rng.integers(0, 9, n)})


def test_positions_and_sizes_match_pandas(spark):
    pdf = frame()
    out = number_rows(spark.createDataFrame(pdf).repartition(7), ["g"], ["o", "id"], "rn", "n").toPandas().set_index("id").sort_index()
    ordered = pdf.sort_values(["g", "o", "id"])
    expected = (ordered.groupby("g").cumcount() + 1).sort_index()
    assert (out["rn"].to_numpy() == expected.to_numpy()).all()
    assert (out["n"].to_numpy() == pdf.groupby("g")["id"].transform("size").to_numpy()).all()


def test_hot_group_spreads_over_ranges(spark):
    from goldpan.operators.ordering import RANGE, into_ranges

    df = spark.createDataFrame(frame()).select("g", "o", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = into_ranges(df, ["g", "o", "id"]).filter("g = 'hot'").select(RANGE).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranges > 1


def test_running_totals_over_all_rows_and_null_groups(spark):
    pdf = frame(500)
    pdf.loc[pdf["g"] == "a", "g"] = None
    df = spark.createDataFrame(pdf)
    out = running_totals(df, ["g"], ["o", "id"], {"upto": F.col("v")}).toPandas()
    expected = pdf.sort_values(["o", "id"]).assign(upto=lambda d: d.groupby("g", dropna=False)["v"].cumsum()).set_index("id")["upto"].sort_index()
    assert (out.set_index("id").sort_index()["upto"] == expected).all()
    whole = running_totals(df, [], ["id"], {"upto": F.col("v")}).toPandas().set_index("id").sort_index()
    assert (whole["upto"].to_numpy() == pdf["v"].cumsum().to_numpy()).all()


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"name": ["x"] * 501 + ["y"] * 40, "value": np.concatenate([rng.integers(0, 20, 501) * 1.0, rng.normal(size=40)])})
    found = positional_values(spark.createDataFrame(pdf), "name", "value", (0.0, 0.25, 0.5, 0.9, 1.0))
    for name, part in pdf.groupby("name"):
        for q, v in found[name].items():
            assert abs(v - np.quantile(part["value"], q)) < 1e-12


def test_top_per_group_keeps_k_rows_before_the_shuffle(spark):
    df = top_per_group(spark.createDataFrame(frame()), ["g"], [F.col("o"), F.col("id")], 3, "r")
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()
    assert df.groupBy("g").count().agg(F.max("count")).first()[0] == 3
