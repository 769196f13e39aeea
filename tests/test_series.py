import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from goldpan.operators import series


def days(spark, values, name="s"):
    start = dt.date(2024, 1, 1)
    return spark.createDataFrame([(name, start + dt.timedelta(days=i), v) for i, v in enumerate(values)], "series_id string, ds date, v double")


def test_rolling_mean_is_null_until_the_window_is_full(spark):
    out = [r["m"] for r in series.rolling_mean(days(spark, [1.0, 2.0, 3.0, None, 5.0]), "v", 2, "m").orderBy("ds").collect()]
    assert out == [None, 1.5, 2.5, None, None]
    short = series.rolling_mean(days(spark, [1.0, 2.0]), "v", 5, "m").filter("m is not null").count()
    assert short == 0


def test_long_rolling_mean_matches_pandas_across_chunks(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": np.where(rng.random(400) < 0.7, "hot", "cold"), "o": rng.integers(0, 50, 400), "id": np.arange(400),
                        "v": rng.integers(0, 100, 400).astype(float)})
    df = spark.createDataFrame(pdf).repartition(5)
    ordered = pdf.sort_values(["g", "o", "id"])
    for n, chunk in ((1, 7), (5, 7), (20, 7), (3, 1000)):
        out = series.rolling_mean_long(df, "v", n, "m", ["g"], ["o", "id"], chunk).toPandas()
        assert len(out) == 400
        expected = ordered.groupby("g")["v"].rolling(n).mean().reset_index(level=0, drop=True).sort_index()
        got = out.set_index("id").sort_index()["m"]
        assert np.allclose(got.to_numpy(dtype=float), expected.to_numpy(), equal_nan=True)


def test_fill_order(spark):
    gaps = days(spark, [None, 1.0, None, 3.0, None])
    out = gaps.select("ds", series.backfill("v").alias("b"), series.forwardfill("v").alias("f"), series.fill_both("v").alias("x")).orderBy("ds").collect()
    assert [r["b"] for r in out] == [1.0, 1.0, 3.0, 3.0, None]
    assert [r["f"] for r in out] == [None, 1.0, 1.0, 3.0, 3.0]
    assert [r["x"] for r in out] == [1.0, 1.0, 3.0, 3.0, 3.0]
    empty = days(spark, [None, None]).select(series.fill_both("v").alias("x")).collect()
    assert [r["x"] for r in empty] == [None, None]


def test_split_tail_and_future(spark):
    df = days(spark, [float(i) for i in range(11)]).unionByName(days(spark, [0.0, 1.0], "t"))
    split = series.time_split(df).filter("is_train").groupBy("series_id").count().collect()
    assert {r[0]: r[1] for r in split} == {"s": 8, "t": 1}
    long = series.time_split_long(df, ["series_id"], ["ds"]).filter("is_train").groupBy("series_id").count().collect()
    assert {r[0]: r[1] for r in long} == {"s": 8, "t": 1}
    assert [r["v"] for r in series.last_rows(df.filter("series_id = 's'"), 3).orderBy("ds").collect()] == [8.0, 9.0, 10.0]
    frame = series.future_frame(df, 5)
    assert frame.count() == 13 + 10
    ends = series.series_end(df)
    assert series.split_at(frame, ends).filter("is_future").count() == 10
    assert series.around_last(frame, ends, 2).filter("series_id = 's'").count() == 5


def test_seasonal_difference(spark):
    out = series.seasonal_difference(days(spark, [1.0, 2.0, 4.0, 8.0, 16.0]), "v", 2, "w").orderBy("ds").collect()
    assert [r["w"] for r in out] == [None, None, None, 3.0, 6.0]


def test_grain_reduces_raw_rows(spark):
    raw = spark.createDataFrame([("a", "2024-01-01 10:01:00", 1), ("a", "2024-01-01 10:59:00", 2), ("a", "2024-01-01 11:00:00", 4)],
                                "k string, t string, v int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    hours = series.to_grain(raw, F.col("k"), F.col("t"), "hour", {"v": F.sum("v")}).orderBy("ds").collect()
    assert [r["v"] for r in hours] == [3, 4]
    assert series.to_grain(raw, F.col("k"), F.col("t"), "day", {"v": F.sum("v")}).first()["v"] == 7


def test_backfill_of_a_long_series_is_linear(spark):
    n = 400_000
    df = spark.range(n).select(F.lit("s").alias("series_id"), F.col("id").alias("ds"), F.when(F.col("id") % 100_000 == 99_999, F.col("id")).alias("v"))
    filled = df.withColumn("b", series.backfill("v")).agg(F.min(F.col("b") - F.col("ds")), F.max(F.col("b") - F.col("ds")), F.count("b")).first()
    assert tuple(filled) == (0, 99_999, n)


@pytest.mark.parametrize("n", [1, 2, 7, 50])
def test_rolling_mean_of_any_length_and_chunk(spark, n):
    import numpy as np

    rng = np.random.default_rng(n)
    rows, expected = [], {}
    for name, length in (("a", 90), ("b", 3), ("c", 49)):
        y = [None if rng.random() < 0.1 and name == "a" else int(v) for v in rng.integers(-10**12, 10**12, length)]
        rows += [(name, i, v) for i, v in enumerate(y)]
        for i in range(length):
            window = y[i - n + 1:i + 1] if i >= n - 1 else [None]
            expected[name, i] = None if None in window else sum(window) / n
    df = spark.createDataFrame(rows, "series_id string, ds int, y long").repartition(5)
    found = {(r["series_id"], r["ds"]): r["m"] for r in series.rolling_mean(df, "y", n, "m").collect()}
    assert found == expected
    for chunk in (n, 13):
        long = series.rolling_mean_long(df, "y", n, "m", ["series_id"], ["ds"], chunk=chunk)
        assert {(r["series_id"], r["ds"]): r["m"] for r in long.collect()} == expected


def test_inferred_steps(spark):
    from datetime import datetime, timedelta

    def months(year, month, day, count, every=1):
        out = []
        for k in range(count):
            m = month - 1 + k * every
            out.append(datetime(year + m // 12, m % 12 + 1, day))
        return out

    start = datetime(2023, 1, 1)
    ends = [d - timedelta(days=1) for d in months(2023, 2, 1, 12)]
    known = {
        "hourly": [start + timedelta(hours=h) for h in (0, 1, 2, 3, 7, 8, 9)], "daily": [start + timedelta(days=d) for d in (0, 1, 2, 5, 6)],
        "weekly": [start + timedelta(weeks=w) for w in range(6)], "monthly": months(2023, 1, 15, 5), "quarterly": months(2023, 1, 1, 5, 3),
        "ends": ends, "odd": [start + timedelta(seconds=90 * k) for k in range(5)], "alone": [start]}
    rows = [(name, d) for name, days in known.items() for d in days]
    df = spark.createDataFrame(rows, "series_id string, ds timestamp_ntz").repartition(4)
    frame = series.future_frame(df, 3)
    ahead = {}
    for r in frame.join(series.series_end(df), "series_id").where("ds > _last").orderBy("ds").collect():
        ahead.setdefault(r["series_id"], []).append(r["ds"])
    assert ahead == {
        "hourly": [start + timedelta(hours=h) for h in (10, 11, 12)], "daily": [start + timedelta(days=d) for d in (7, 8, 9)],
        "weekly": [start + timedelta(weeks=w) for w in (6, 7, 8)], "monthly": months(2023, 6, 15, 3), "quarterly": months(2024, 4, 1, 3, 3),
        "ends": [datetime(2024, 1, 31), datetime(2024, 2, 29), datetime(2024, 3, 31)], "odd": [start + timedelta(seconds=90 * k) for k in (5, 6, 7)],
        "alone": [start + timedelta(days=d) for d in (1, 2, 3)]}
    assert frame.count() == len(rows) + 24
