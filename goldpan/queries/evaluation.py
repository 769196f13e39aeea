"""Metrics, scores and leaderboards over rule-based predictions, and evaluations of fitted models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.evaluation import metrics, scoring
from goldpan.operators import series, split
from goldpan.queries.features import LINE_KEY, LINE_KEY_SQL
from goldpan.queries.registry import query, table
from goldpan.queries.series import DAILY_SQL, daily

RUNS = 3

# rules that stand in for classifiers of "the line was returned": name -> score as SQL, the same text on both engines
CLASS_RULES = {
    "discount": "l_discount * 10",
    "quantity": "l_quantity / 50",
    "tax_discount": "(l_tax + l_discount) * 5.5",
    "price": "CASE WHEN l_extendedprice > 50000 THEN 0.7 ELSE 0.2 END",
    "label_copy": "CASE WHEN l_returnflag = 'R' THEN 0.9 ELSE 0.1 END",
    "never": "CAST(NULL AS DOUBLE)",
}
_CLASS_SQL = f"""
    predictions AS (
        SELECT 'classification' AS problem, model, CAST(run AS INTEGER) AS run, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, score,
               CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS yhat
        FROM (SELECT *, unnest(range(0, {RUNS})) AS run FROM lineitem) l,
             LATERAL (VALUES {', '.join(f"('{m}', CAST({e} AS DOUBLE))" for m, e in CLASS_RULES.items())}) r(model, score)
        WHERE substr(md5(run || '|' || {LINE_KEY_SQL}), 1, 8) < '33333333')"""


def class_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows of every run with the prediction of every rule."""
    lines = table(spark, folder, "lineitem").select(*LINE_KEY, "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    rules = F.array(*[F.struct(F.lit(m).alias("model"), F.expr(e).cast("double").alias("score")) for m, e in CLASS_RULES.items()])
    tests = split.repeated_holdout(lines, LINE_KEY, 0.2, RUNS).filter("is_test")
    return tests.select(
        "run", F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"), F.explode(rules).alias("r")
    ).select(F.lit("classification").alias("problem"), "r.model", "run", "y", "r.score",
             F.when(F.col("r.score") >= 0.5, 1).otherwise(0).alias("yhat"))


BY = ["problem", "model", "run"]


def _rounded(df: DataFrame, names: list[str], keys: list[str] = BY) -> DataFrame:
    return df.select(*keys, *[F.round(n, 6).alias(n) for n in names])


@query("q_metric_accuracy", f"""
    WITH {_CLASS_SQL} SELECT problem, model, run, round(avg(CASE WHEN y = yhat THEN 1.0::DOUBLE ELSE 0 END), 6) AS test_accuracy
    FROM predictions GROUP BY ALL""")
def metric_accuracy(spark, folder):
    return _rounded(metrics.accuracy(class_predictions(spark, folder), BY), ["test_accuracy"])


_PRF_SQL = """
    confusion AS (SELECT problem, model, run, y, yhat, count(*) AS n FROM predictions GROUP BY ALL),
    classes AS (SELECT problem, model, run, y AS c FROM confusion UNION SELECT problem, model, run, yhat FROM confusion),
    per_class AS (
        SELECT k.problem, k.model, k.run, k.c, sum(CASE WHEN f.y = k.c THEN n ELSE 0 END) AS support, sum(CASE WHEN f.yhat = k.c THEN n ELSE 0 END) AS predicted,
               sum(CASE WHEN f.y = k.c AND f.yhat = k.c THEN n ELSE 0 END) AS hits
        FROM classes k JOIN confusion f USING (problem, model, run) GROUP BY ALL),
    rated AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hits::DOUBLE / predicted END AS p, CASE WHEN support = 0 THEN 0 ELSE hits::DOUBLE / support END AS r FROM per_class),
    prf AS (
        SELECT problem, model, run, sum(hits)::DOUBLE / sum(support) AS test_accuracy,
               sum(support * CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END) / sum(support) AS test_f1,
               sum(support * p) / sum(support) AS test_precision, sum(support * r) / sum(support) AS test_recall
        FROM rated GROUP BY ALL)"""


@query("q_metric_weighted_prf", f"""
    WITH {_CLASS_SQL}, {_PRF_SQL} SELECT problem, model, run, round(test_f1, 6) AS test_f1, round(test_precision, 6) AS test_precision,
    round(test_recall, 6) AS test_recall FROM prf""")
def metric_weighted_prf(spark, folder):
    return _rounded(metrics.class_metrics(class_predictions(spark, folder), BY), ["test_f1", "test_precision", "test_recall"])


_AUC_SQL = """
    per_score AS (SELECT problem, model, run, score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg
                  FROM predictions WHERE score IS NOT NULL GROUP BY ALL),
    ranked AS (SELECT *, sum(neg) OVER (PARTITION BY problem, model, run ORDER BY score) AS upto FROM per_score),
    auc AS (SELECT problem, model, run, sum(pos * (upto - neg / 2.0::DOUBLE)) / (sum(pos) * sum(neg)) AS test_roc_auc FROM ranked GROUP BY ALL)"""


@query("q_metric_auc", f"WITH {_CLASS_SQL}, {_AUC_SQL} SELECT problem, model, run, round(test_roc_auc, 6) AS test_roc_auc FROM auc")
def metric_auc(spark, folder):
    return _rounded(metrics.roc_auc(class_predictions(spark, folder), BY), ["test_roc_auc"])


_METRICS_SQL = f"""{_CLASS_SQL}, {_PRF_SQL}, {_AUC_SQL},
    results AS (SELECT prf.*, coalesce(test_roc_auc, 0) AS test_roc_auc FROM prf LEFT JOIN auc USING (problem, model, run))"""
CLASS_METRICS = ["test_accuracy", "test_f1", "test_precision", "test_recall", "test_roc_auc"]


def _norm_sql(names: list[str], source: str, by: str = "problem") -> str:
    parts = ", ".join(
        f"CASE WHEN max({m}) OVER w = min({m}) OVER w THEN 0 ELSE ({m} - min({m}) OVER w) / (max({m}) OVER w - min({m}) OVER w) END AS norm_{m}" for m in names)
    return f"normed AS (SELECT *, {parts} FROM {source} WINDOW w AS (PARTITION BY {by}))"


_CLASS_SCORED = f"""{_METRICS_SQL}, {_norm_sql(CLASS_METRICS, 'results')},
    flagged AS (SELECT *, {' AND '.join(f'norm_{m} > 0.98' for m in CLASS_METRICS)} AS overfit_flag FROM normed),
    scored AS (SELECT *, CASE WHEN overfit_flag THEN 0.5 ELSE 1.0 END * (0.40 * norm_test_f1 + 0.25 * norm_test_accuracy + 0.15 * norm_test_precision
                         + 0.10 * norm_test_recall + 0.10 * norm_test_roc_auc) AS golden_score FROM flagged)"""


def class_scores(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.score_classification(metrics.classification_metrics(class_predictions(spark, folder), BY))


@query("q_normalize_metrics", f"""
    WITH {_CLASS_SCORED} SELECT problem, model, run, {', '.join(f'round(norm_{m}, 6) AS norm_{m}' for m in CLASS_METRICS)} FROM scored""")
def normalize_metrics(spark, folder):
    return _rounded(class_scores(spark, folder), [f"norm_{m}" for m in CLASS_METRICS])


@query("q_overfit_flag_clf", f"WITH {_CLASS_SCORED} SELECT problem, model, run, overfit_flag FROM scored")
def overfit_flag_clf(spark, folder):
    return class_scores(spark, folder).select(*BY, "overfit_flag")


@query("q_golden_clf", f"WITH {_CLASS_SCORED} SELECT problem, model, run, round(golden_score, 6) AS golden_score FROM scored")
def golden_clf(spark, folder):
    return _rounded(class_scores(spark, folder), ["golden_score"])


# rules that stand in for regressors of the extended price
PRICE_RULES = {
    "by_quantity": "l_quantity * 1500",
    "flat": "50000",
    "by_discount": "l_quantity * 1500 * (1 - l_discount)",
    "memorized": "CASE WHEN is_test THEN l_quantity * 1400 ELSE l_extendedprice + 100 END",
}
_PRICE_SQL = f"""
    predictions AS (
        SELECT 'regression' AS problem, model, CAST(run AS INTEGER) AS run, is_test, l_extendedprice AS y, yhat
        FROM (SELECT *, substr(md5(run || '|' || {LINE_KEY_SQL}), 1, 8) < '33333333' AS is_test
              FROM (SELECT *, unnest(range(0, {RUNS})) AS run FROM lineitem)) l,
             LATERAL (VALUES {', '.join(f"('{m}', CAST({e} AS DOUBLE))" for m, e in PRICE_RULES.items())}) r(model, yhat)),
    results AS (
        SELECT problem, model, run, avg(abs(y - yhat)) FILTER (NOT is_test) AS train_mae, avg(abs(y - yhat)) FILTER (is_test) AS test_mae,
               avg((y - yhat) * (y - yhat)) FILTER (is_test) AS test_mse, sqrt(avg((y - yhat) * (y - yhat)) FILTER (is_test)) AS test_rmse,
               1 - avg((y - yhat) * (y - yhat)) FILTER (is_test) / var_pop(y) FILTER (is_test) AS test_r2
        FROM predictions GROUP BY ALL)"""
PRICE_METRICS = ["test_mae", "test_mse", "test_rmse", "test_r2"]


def price_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every run, training and test, with the prediction of every rule."""
    lines = table(spark, folder, "lineitem").select(*LINE_KEY, "l_quantity", "l_extendedprice", "l_discount")
    rules = F.array(*[F.struct(F.lit(m).alias("model"), F.expr(e).cast("double").alias("yhat")) for m, e in PRICE_RULES.items()])
    rows = split.repeated_holdout(lines, LINE_KEY, 0.2, RUNS)
    return rows.select("run", "is_test", F.col("l_extendedprice").alias("y"), F.explode(rules).alias("r")).select(
        F.lit("regression").alias("problem"), "r.model", "run", "is_test", "y", "r.yhat")


def price_results(spark: SparkSession, folder: str) -> DataFrame:
    """Test metrics and training MAE of every rule and run, from one pass over the predictions."""
    both = metrics.regression_metrics(price_predictions(spark, folder), [*BY, "is_test"])
    names = ["test_mae", "test_mse", "test_rmse", "test_r2"]
    picked = [F.max(F.when(F.col("is_test"), F.col(n))).alias(n) for n in names]
    return both.groupBy(*BY).agg(F.max(F.when(~F.col("is_test"), F.col("test_mae"))).alias("train_mae"), *picked)


@query("q_metric_mae_mse", f"WITH {_PRICE_SQL} SELECT problem, model, run, round(test_mae, 4) AS test_mae, round(test_mse, 1) AS test_mse FROM results")
def metric_mae_mse(spark, folder):
    return price_results(spark, folder).select(*BY, F.round("test_mae", 4).alias("test_mae"), F.round("test_mse", 1).alias("test_mse"))


@query("q_metric_rmse", f"WITH {_PRICE_SQL} SELECT problem, model, run, round(test_rmse, 4) AS test_rmse FROM results")
def metric_rmse(spark, folder):
    return price_results(spark, folder).select(*BY, F.round("test_rmse", 4).alias("test_rmse"))


@query("q_metric_r2", f"WITH {_PRICE_SQL} SELECT problem, model, run, round(test_r2, 6) AS test_r2 FROM results")
def metric_r2(spark, folder):
    return price_results(spark, folder).select(*BY, F.round("test_r2", 6).alias("test_r2"))


_AVERAGED = f"""{_PRICE_SQL},
    averaged AS (SELECT problem, model, avg(train_mae) AS train_mae, avg(test_mae) AS test_mae, avg(test_mse) AS test_mse,
                        avg(test_rmse) AS test_rmse, avg(test_r2) AS test_r2 FROM results GROUP BY ALL)"""


@query("q_run_average", f"""
    WITH {_AVERAGED} SELECT problem, model, round(train_mae, 4) AS train_mae, round(test_mae, 4) AS test_mae, round(test_rmse, 4) AS test_rmse,
    round(test_r2, 6) AS test_r2 FROM averaged""")
def run_average(spark, folder):
    mean = scoring.average_runs(price_results(spark, folder), ["train_mae", *PRICE_METRICS])
    return mean.select("problem", "model", *[F.round(m, 4).alias(m) for m in ("train_mae", "test_mae", "test_rmse")], F.round("test_r2", 6).alias("test_r2"))


_REG_SCORED = f"""{_PRICE_SQL}, {_norm_sql(['test_mae', 'test_mse', 'test_r2'], 'results')},
    scored AS (SELECT *, 0.40 * (1 - norm_test_mae) + 0.30 * (1 - norm_test_mse) + 0.30 * norm_test_r2 AS golden_score FROM normed)"""


@query("q_golden_reg", f"WITH {_REG_SCORED} SELECT problem, model, run, round(golden_score, 6) AS golden_score FROM scored")
def golden_reg(spark, folder):
    return _rounded(scoring.score_regression(price_results(spark, folder)), ["golden_score"])


@query("q_golden_reg_penalty", f"""
    WITH {_AVERAGED}, {_norm_sql(['test_mae', 'test_rmse', 'test_r2'], 'averaged')}
    SELECT problem, model, CASE WHEN train_mae < 0.5 * test_mae THEN 0.15::DOUBLE ELSE 0 END AS overfit_penalty,
           round(0.40 * (1 - norm_test_mae) + 0.30 * (1 - norm_test_rmse) + 0.30 * norm_test_r2 - CASE WHEN train_mae < 0.5 * test_mae THEN 0.15 ELSE 0 END, 6) AS golden_score
    FROM normed""")
def golden_reg_penalty(spark, folder):
    scored = scoring.score_regression_averaged(price_results(spark, folder))
    return scored.select("problem", "model", "overfit_penalty", F.round("golden_score", 6).alias("golden_score"))


@query("q_leaderboard", f"""
    WITH {_REG_SCORED} SELECT problem, CAST(row_number() OVER (PARTITION BY problem ORDER BY golden_score DESC, model, run) AS INTEGER) AS rank,
    model, run, round(golden_score, 6) AS golden_score FROM scored""")
def leaderboard(spark, folder):
    board = scoring.leaderboard(scoring.score_regression(price_results(spark, folder)))
    return board.select("problem", "rank", "model", "run", F.round("golden_score", 6).alias("golden_score"))


_TS_SQL = f"""
    {DAILY_SQL},
    split AS (SELECT series_id, ds, cents / 100.0::DOUBLE AS y, lag(cents, 1) OVER w / 100.0::DOUBLE AS previous, lag(cents, 7) OVER w / 100.0::DOUBLE AS week,
                     row_number() OVER w > floor(count(*) OVER (PARTITION BY series_id) * 0.8) AS is_test
              FROM daily WINDOW w AS (PARTITION BY series_id ORDER BY ds)),
    results AS (
        SELECT 'time-series' AS problem, model, series_id, avg(abs(y - yhat)) AS test_mae, avg((y - yhat) * (y - yhat)) AS test_mse,
               1 - avg((y - yhat) * (y - yhat)) / var_pop(y) AS test_r2
        FROM split, LATERAL (VALUES ('previous', previous), ('week', week), ('flat', 150000.0::DOUBLE)) r(model, yhat) WHERE is_test GROUP BY ALL)"""


@query("q_golden_ts", f"""
    WITH {_TS_SQL}, {_norm_sql(['test_mae', 'test_mse', 'test_r2'], 'results')}
    SELECT problem, model, series_id, round(0.50 * (1 - norm_test_mae) + 0.30 * (1 - norm_test_mse) + 0.20 * norm_test_r2, 6) AS golden_score FROM normed""")
def golden_ts(spark, folder):
    days = daily(spark, folder).select("series_id", "ds", (F.col("cents") / 100).alias("y"))
    lagged = series.time_split(series.lags(days, "y", 7)).filter(~F.col("is_train"))
    rules = F.array(*[F.struct(F.lit(m).alias("model"), v.alias("yhat")) for m, v in
                      (("previous", F.col("lag1")), ("week", F.col("lag7")), ("flat", F.lit(150000.0)))])
    predicted = lagged.select("series_id", "y", F.explode(rules).alias("r")).select(F.lit("time-series").alias("problem"), "series_id", "y", "r.*")
    scored = scoring.score_regression(metrics.regression_metrics(predicted, ["problem", "model", "series_id"]), scoring.TIME_SERIES_WEIGHTS)
    return scored.select("problem", "model", "series_id", F.round("golden_score", 6).alias("golden_score"))
