"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is executed in full into the noop sink, so neither Python rows nor result files are part of the time.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from goldpan.queries import QUERIES

HEADLINE = [
    "q_etl_table", "q_etl_report", "q_lake_write_overwrite", "q_config_catalog", "q_group_nonnull_count", "q_standardize", "q_robust_scale",
    "q_stratified_holdout", "q_repeated_holdout", "q_rolling_mean_400", "q_rolling_mean_raw", "q_forecast_frame", "q_golden_clf",
    "q_golden_reg_penalty", "q_metric_auc", "q_clf_gaussian_nb", "q_clf_lda", "q_reg_linear", "q_reg_gbt", "q_knn_join", "q_anom_lof",
    "q_forecast_future",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="bench-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
