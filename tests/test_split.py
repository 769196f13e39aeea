import math

from pyspark.sql import functions as F

from goldpan.operators import split


def rows(spark, n=1000):
    return spark.range(n).withColumn("y", F.when(F.col("id") % 10 == 0, 1.0).otherwise(0.0))


def test_exact_sizes_per_stratum(spark):
    marked = split.exact_holdout(rows(spark, 1003), ["id"], 0.2, 7, ["y"]).groupBy("y").agg(
        F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()
    assert all(r["t"] == math.ceil(0.2 * r["n"]) for r in marked)
    whole = split.exact_holdout(rows(spark, 1003), ["id"], 0.2, 7)
    assert whole.filter("is_test").count() == math.ceil(0.2 * 1003) and whole.count() == 1003


def test_split_does_not_depend_on_partitions(spark):
    a = {r[0] for r in split.exact_holdout(rows(spark).repartition(9), ["id"], 0.3, 1).filter("is_test").select("id").collect()}
    b = {r[0] for r in split.exact_holdout(rows(spark).coalesce(1), ["id"], 0.3, 1).filter("is_test").select("id").collect()}
    assert a == b
    assert a != {r[0] for r in split.exact_holdout(rows(spark), ["id"], 0.3, 2).filter("is_test").select("id").collect()}


def test_repeated_holdout_covers_every_row_in_every_run(spark):
    out = split.repeated_holdout(rows(spark), ["id"], 0.2, 5)
    per_run = out.groupBy("run").agg(F.countDistinct("id").alias("n"), F.avg(F.col("is_test").cast("double")).alias("share")).collect()
    assert len(per_run) == 5 and all(r["n"] == 1000 and 0.13 < r["share"] < 0.27 for r in per_run)


def test_folds_are_disjoint_and_complete(spark):
    counts = split.folds(rows(spark), ["id"], 5).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in counts) == [0, 1, 2, 3, 4] and sum(r["count"] for r in counts) == 1000


def test_rows_are_not_shuffled_by_stratum(spark, monkeypatch):
    """A stratum with most rows never meets in one task; with many strata its rows are dealt, with the same result."""
    df = rows(spark, 2000).withColumn("y", F.when(F.col("id") % 50 > 0, F.lit("most")).when(F.col("id") % 100 > 0, F.lit("few")))
    marked = split.exact_holdout(df, ["id"], 0.2, 7, ["y"])
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    few = {(r["id"], r["is_test"]) for r in marked.collect()}
    monkeypatch.setattr(split, "FEW_STRATA", 1)
    many = split.exact_holdout(df, ["id"], 0.2, 7, ["y"])
    assert "_salt" in many._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["id"], r["is_test"]) for r in many.collect()} == few and len(few) == 2000
    assert sum(t for _, t in few) == math.ceil(0.2 * 1960) + 2 * math.ceil(0.2 * 20)
