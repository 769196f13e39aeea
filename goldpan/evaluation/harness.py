"""Evaluate configured models over repeated holdouts and rank them.

Every (run, model) is fitted by Spark jobs and judged by aggregations over its predictions; only metric rows, one
per model and run, reach the driver.  A fit that fails ends the evaluation: scores are normalized over all models, so a ranking
without some of them is no result.  A configured evaluation (``evaluate``) reports it in the status rows and goes on.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_EXCEPTION, Future, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.evaluation import metrics, scoring
from goldpan.models import forecast, registry
from goldpan.models.base import Fit
from goldpan.operators import features as prep
from goldpan.operators import series, split
from goldpan.operators.columns import drop_null_rows
from goldpan.session import for_loops, materialize, scratch_path

PARALLEL_MODELS = 4  # fits at the same time, at least; with more cores one per core
OPEN_RUNS = 2  # runs whose rows are stored at the same time
STATUS = "problem string, model string, run int, status string, message string"
PREDICTIONS = "model string, run int, y double, yhat double, score double"
REGRESSION_ROWS = ("problem string, model string, run int, train_mae double, test_mae double, test_mse double,"
                   " test_rmse double, test_r2 double")


def resolve(problem: str, models: Mapping[str, object]) -> dict[str, Fit | Exception]:
    """Configured names to models; what cannot be built stays in the result as its error."""
    built: dict[str, Fit | Exception] = {}
    for name, given in models.items():
        try:
            built[name] = given if callable(given) else registry.build(problem, name, given)
        except (ValueError, TypeError) as error:
            built[name] = error
    return built


def _failure(error: Exception) -> str:
    return f"{type(error).__name__}: {(str(error).splitlines() or [''])[0]}"


def fit_all(
    df: DataFrame,
    problem: str,
    columns: Sequence[str],
    models: Mapping[str, object],
    keys: Sequence[str],
    consume: Callable[[str, int, DataFrame], None],
    runs: int = 5,
    fraction: float = 0.2,
    fit_on: str = "train",
    parallel: int | None = None,
    report: bool = False,
) -> DataFrame:
    """Fit every model in every run, hand its predictions to ``consume``, and return the status of every (model, run).

    ``fit_on="all"`` scales with the moments of all rows before the split; the default uses training rows only.  A model that cannot be
    built or fitted is an error here; with ``report`` it has a row with the status "failed" and its reason, and the others go on.
    """
    spark = df.sparkSession
    built = resolve(problem, models)
    unknown = [f"{name}: {_failure(fit)}" for name, fit in built.items() if isinstance(fit, Exception)]
    if unknown and not report:
        raise ValueError("; ".join(unknown))
    status: list[tuple] = []
    wide = prep.fit_standard(df, columns) if fit_on == "all" else None
    strata = ["y"] if problem == "classification" else []
    n = df.count()

    def one(name: str, fit: Fit | Exception, run: int, rows: DataFrame, train: DataFrame) -> tuple:
        try:
            if isinstance(fit, Exception):
                raise fit
            predict = fit(train)
            # the training error is part of a regression result; a classifier is judged on test rows only
            consume(name, run, predict(rows if problem == "regression" else rows.filter("is_test")))
            return problem, name, run, "ok", None
        except Exception as error:
            if not report:
                raise RuntimeError(f"{name}, run {run}: {_failure(error)}") from error
            return problem, name, run, "failed", _failure(error)

    def close(marked: DataFrame, fits: list[Future]) -> None:
        ended, _ = wait(fits, return_when=FIRST_EXCEPTION)
        failures = [str(f.exception()) for f in fits if f in ended and f.exception()]
        if failures:
            raise RuntimeError("; ".join(failures))
        status.extend(f.result() for f in fits)
        marked.unpersist()

    # fits are sequences of small jobs; several at a time fill the cores, and the last ones of a run go on beside the first ones of the next
    opened: list[tuple[DataFrame, list[Future]]] = []
    with ThreadPoolExecutor(parallel or max(PARALLEL_MODELS, spark.sparkContext.defaultParallelism)) as pool:
        try:
            for run in range(runs):
                if len(opened) == OPEN_RUNS:
                    close(*opened[0])
                    opened.pop(0)
                # stored for all models of the run; one shuffle evens out the partitions that every fit iterates over
                marked = for_loops(split.exact_holdout(df, keys, fraction, run, strata), keys, n).persist()
                scale = wide or prep.fit_standard(marked.filter(~F.col("is_test")), columns)
                rows = prep.assemble(scale.transform(marked), columns)
                train = rows.filter(~F.col("is_test")).drop("is_test")
                opened.append((marked, [pool.submit(inheritable_thread_target(spark)(one), name, fit, run, rows, train) for name, fit in built.items()]))
            for each in opened:
                close(*each)
        except BaseException:  # fits that have begun are waited for, no other one begins
            pool.shutdown(cancel_futures=True)
            for marked, _ in opened:
                marked.unpersist()
            raise
    return spark.createDataFrame(status, STATUS)


def evaluate_classification(df: DataFrame, columns: Sequence[str], models: Mapping[str, object], keys: Sequence[str],
                            weights: Mapping[str, float] = scoring.CLASSIFICATION_WEIGHTS, **options) -> tuple[DataFrame, DataFrame]:
    """Ranked metric rows per model and run, and the status rows.  ``df`` has numeric ``columns``, ``y`` and ``keys``.

    The test predictions are stored once, because the ROC curve needs more than one pass over them; one aggregation
    over all of them then gives the metrics of all models and runs.
    """
    spark = df.sparkSession
    paths: list[str] = []  # one folder per fit, as several are written at a time

    def store(name: str, run: int, out: DataFrame) -> None:
        path = scratch_path(spark, "predictions")
        out.select(F.lit(name).alias("model"), F.lit(run).alias("run"), F.col("y").cast("double").alias("y"),
                   F.col("yhat").cast("double").alias("yhat"), "score").write.parquet(path)
        paths.append(path)

    status = fit_all(df, "classification", columns, models, keys, store, **options)
    written = spark.read.schema(PREDICTIONS).parquet(*paths) if paths else spark.createDataFrame([], PREDICTIONS)
    rows = metrics.classification_metrics(written, ["model", "run"]).withColumn("problem", F.lit("classification"))
    return scoring.leaderboard(scoring.score_classification(materialize(rows), weights)), status


def evaluate_regression(df: DataFrame, columns: Sequence[str], models: Mapping[str, object], keys: Sequence[str],
                        weights: Mapping[str, float] = scoring.REGRESSION_WEIGHTS, **options) -> tuple[DataFrame, DataFrame]:
    """As for classification, with the training MAE next to the test metrics.

    One aggregation per fit: two rows of sums come back, no prediction is stored.
    """
    found: list[tuple] = []

    def judge(name: str, run: int, out: DataFrame) -> None:
        parts = {r["is_test"]: r for r in metrics.regression_metrics(out.select("is_test", "y", "yhat"), ["is_test"], "").collect()}
        test = parts[True]
        found.append(("regression", name, run, parts[False]["mae"], test["mae"], test["mse"], test["rmse"], test["r2"]))

    status = fit_all(df, "regression", columns, models, keys, judge, **options)
    rows = df.sparkSession.createDataFrame(found, REGRESSION_ROWS)
    return scoring.leaderboard(scoring.score_regression(rows, weights)), status


def _autoregression(train: DataFrame, test: DataFrame, horizon: int) -> DataFrame:
    return _by_step(forecast.autoregression(train, horizon), test)


def _seasonal(train: DataFrame, test: DataFrame, horizon: int) -> DataFrame:
    return _by_step(forecast.seasonal(train, horizon), test)


def _decomposition(train: DataFrame, test: DataFrame, horizon: int) -> DataFrame:
    model = forecast.Decomposition(daily=4, yearly=10)
    return model.predict(model.fit(train), test)


def _by_step(steps: DataFrame, test: DataFrame) -> DataFrame:
    return test.join(steps, ["series_id", "step"])


FORECASTERS: dict[str, Callable[[DataFrame, DataFrame, int], DataFrame]] = {
    "ARIMA": _autoregression,
    "SARIMA": _seasonal,
    "Prophet": _decomposition,
}


def evaluate_time_series(df: DataFrame, models: Sequence[str] = registry.TIME_SERIES, share: float = 0.8,
                         weights: Mapping[str, float] = scoring.TIME_SERIES_WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """One chronological split per series; metric rows per model and series, ranked per series.

    ``df`` has series_id, ds and y at a fixed grain.  A series too short to have a training and a test part is reported as such.
    """
    spark = df.sparkSession
    known = materialize(series.time_split(drop_null_rows(df.select("series_id", "ds", "y"), ["ds", "y"]), share))
    train = known.filter("is_train").drop("is_train")
    test = series.number_tests(known.filter(~F.col("is_train")).drop("is_train"))
    horizon = test.agg(F.max("step")).first()[0] or 0
    path = scratch_path(spark, "forecasts")
    status = []
    for name in models:
        try:
            if name not in FORECASTERS:
                raise ValueError(f"no time-series model {name!r}")
            out = FORECASTERS[name](train, test, horizon)
            out.select(F.lit(name).alias("model"), "series_id", "y", "yhat").write.mode("append").parquet(path)
            status.append(("time-series", name, 0, "ok", None))
        except Exception as error:
            status.append(("time-series", name, 0, "failed", _failure(error)))
    if not any(s[3] == "ok" for s in status):
        raise RuntimeError("; ".join(s[4] for s in status))
    written = spark.read.parquet(path)
    rows = metrics.regression_metrics(written, ["model", "series_id"]).withColumn("problem", F.concat(F.lit("time-series/"), "series_id"))
    short = known.groupBy("series_id").agg(F.count_if("is_train").alias("_train"), F.count("*").alias("_all")).where("_train = 0 or _train = _all")
    unjudged = short.select(
        F.lit("time-series").alias("problem"), F.lit(None).cast("string").alias("model"), F.lit(0).alias("run"), F.lit("skipped").alias("status"),
        F.concat(F.lit("series "), F.col("series_id").cast("string"), F.lit(" has no training or no test part")).alias("message"))
    return scoring.leaderboard(scoring.score_regression(materialize(rows), weights)), spark.createDataFrame(status, STATUS).unionByName(unjudged)


FLAGS = "model string, row_id long, score double, is_outlier boolean"


def detect_anomalies(df: DataFrame, columns: Sequence[str], models: Mapping[str, object], row_id: str,
                     parallel: int = PARALLEL_MODELS) -> tuple[DataFrame, DataFrame]:
    """Score and flag of every row by every configured detector (``FLAGS``), and the status rows.

    ``df`` has numeric ``columns`` and a unique integer ``row_id``; the columns are standardized first.
    """
    spark = df.sparkSession
    plain = df.select(F.col(row_id).cast("long").alias("row_id"), *columns)
    rows = materialize(prep.assemble(prep.fit_standard(plain, columns).transform(plain), columns).select("row_id", "features"))
    paths: list[str] = []

    def one(name: str, detect: Callable[[DataFrame], DataFrame] | Exception) -> tuple:
        try:
            if isinstance(detect, Exception):
                raise detect
            path = scratch_path(spark, "flags")
            detect(rows).select(F.lit(name).alias("model"), "row_id", F.col("score").cast("double").alias("score"), "is_outlier").write.parquet(path)
            paths.append(path)
            return "anomaly-detection", name, 0, "ok", None
        except Exception as error:
            return "anomaly-detection", name, 0, "failed", _failure(error)

    built = resolve("anomaly-detection", models)
    with ThreadPoolExecutor(parallel) as pool:
        status = list(pool.map(inheritable_thread_target(spark)(one), built, built.values()))
    flags = spark.read.schema(FLAGS).parquet(*paths) if paths else spark.createDataFrame([], FLAGS)
    return flags, spark.createDataFrame(status, STATUS)


def evaluate(df: DataFrame, problem: str, config: Mapping, columns: Sequence[str] = (), keys: Sequence[str] = (),
             date_column: str | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """Evaluate the models of an evaluation configuration ``{problem: {models, target_col, Golden Score}}``.

    Detectors of anomalies have no target to be ranked by; their flags are the result.
    """
    if problem not in ("classification", "regression", "time-series", "anomaly-detection"):
        raise ValueError(f"invalid problem type: {problem!r}")
    if problem not in config:
        raise ValueError(f"problem type {problem!r} is not configured")
    section = config[problem]
    if problem == "anomaly-detection":
        if len(keys) != 1:
            raise ValueError("anomaly detection needs the one key column of a row")
        return detect_anomalies(df, columns, section["models"], keys[0], **options)
    weights = section["Golden Score"]
    target = section.get("target_col") or "y"
    if problem == "time-series":
        if date_column is None:
            raise ValueError("time-series models need a date column")
        renamed = df.withColumnsRenamed({target: "y", date_column: "ds"})
        if "series_id" not in renamed.columns:
            # one series of the mean per moment: as long as the calendar, not as the table
            renamed = renamed.groupBy("ds").agg(F.avg("y").alias("y")).withColumn("series_id", F.lit("all"))
        return evaluate_time_series(renamed, list(section["models"]), weights=weights, **options)
    if not keys:
        raise ValueError("the holdout needs the key columns of a row")
    run = evaluate_classification if problem == "classification" else evaluate_regression
    return run(df.withColumnRenamed(target, "y"), columns, section["models"], keys, weights=weights, report=True, **options)


def save_leaderboard(board: DataFrame, path: str) -> None:
    """Result tables are small; one CSV with a header."""
    board.coalesce(1).write.mode("overwrite").csv(path, header=True)


def read_config(spark: SparkSession, path: str) -> Mapping:
    """An evaluation configuration from any file system Spark can read."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])
