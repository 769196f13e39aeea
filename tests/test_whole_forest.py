"""Findings of the review on models: no part of the table is left out."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from goldpan.models import anomaly


def test_each_tree_draws_from_the_whole_table(spark):
    rows = spark.range(40_000).select(F.col("id").alias("row_id"), F.array(F.col("id").cast("double")).alias("v"))
    samples = anomaly._samples(rows, 40_000, 100, 42, "row_id")
    per_tree = samples.groupBy("tree").count().collect()
    assert len(per_tree) == 100 and {r["count"] for r in per_tree} == {anomaly.SAMPLE_ROWS}
    # 25,600 draws from 40,000 rows meet 1 - e^-0.64 of them; one pool for all trees had 8,192
    assert samples.select("row_id").distinct().count() > 18_000
    scored = anomaly.isolation_forest(rows.select("row_id", array_to_vector("v").alias("features")))
    assert scored.where("anomaly_score > 0 AND anomaly_score <= 1").count() == 40_000
