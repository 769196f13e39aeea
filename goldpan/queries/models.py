"""One query per model: fitted on the training rows of a keyed holdout, judged on the test rows."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.evaluation import harness, metrics
from goldpan.models import anomaly, classifiers, regressors, registry
from goldpan.models.base import Fit
from goldpan.operators import features, neighbors, split
from goldpan.plans import search
from goldpan.queries.features import LINE_KEY, LINE_KEY_SQL, PRICE_FEATURES, priced_lines
from goldpan.queries.registry import query, table
from goldpan.session import for_loops, materialize, scratch_path

FOLDS = 3
TEXT_FEATURES = ["n_chars", "n_words", "n_lines", "digit_share", "upper_share", "mean_word"]


def labeled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Quality label of documents with counts over their whole text."""
    documents = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    length = F.greatest(F.length("text"), F.lit(1))

    def found(pattern: str):
        return F.regexp_count("text", F.lit(pattern))

    return documents.select(
        F.col("doc_id").alias("row_id"), F.length("text").cast("double").alias("n_chars"), found(r"\S+").cast("double").alias("n_words"),
        (found(r"\n") + 1).cast("double").alias("n_lines"), (found(r"\d") / length).alias("digit_share"),
        (found(r"[A-Z]") / length).alias("upper_share"), (length / F.greatest(found(r"\S+"), F.lit(1))).alias("mean_word"),
        F.col("quality").cast("double").alias("y"))


def _judge_classifier(spark, folder, fit: Fit) -> DataFrame:
    """Metrics of one classifier on the document labels."""
    documents = materialize(labeled_documents(spark, folder))  # the texts are read once
    marked = for_loops(split.exact_holdout(documents, ["row_id"], 0.2, 42, ["y"]), ["row_id"], documents.count()).persist()
    scale = features.fit_standard(marked.filter(~F.col("is_test")), TEXT_FEATURES)
    rows = features.assemble(scale.transform(marked), TEXT_FEATURES).select("row_id", "features", "y", "is_test")
    predicted = fit(rows.filter(~F.col("is_test")))(rows.filter("is_test"))
    kept = materialize(predicted.select(F.lit("all").alias("part"), "y", "yhat", "score"))
    marked.unpersist()
    sizes = kept.groupBy("part").agg(F.count("*").alias("test_rows"))
    return metrics.classification_metrics(kept, ["part"]).join(sizes, "part").drop("part")


def _judge_regressor(spark, folder, fit: Fit) -> DataFrame:
    """Metrics of one regressor on the charge of the lines."""
    marked = split.folds(split.holdout(priced_lines(spark, folder), LINE_KEY, 0.2, 42), LINE_KEY, FOLDS)
    marked = marked.repartition(*LINE_KEY).persist()  # even partitions for every iteration of the fit
    scale = features.fit_standard(marked.filter(~F.col("is_test")), PRICE_FEATURES)
    rows = features.assemble(scale.transform(marked), PRICE_FEATURES).select("features", "y", "is_test", "fold")
    predicted = fit(rows.filter(~F.col("is_test")))(rows.filter("is_test"))
    judged = materialize(metrics.regression_metrics(predicted.select(F.lit("all").alias("part"), "y", "yhat"), ["part"]).drop("part"))
    marked.unpersist()
    return judged


def _classifier(name: str, build) -> None:
    query(name)(lambda spark, folder: _judge_classifier(spark, folder, build()))


def _regressor(name: str, build) -> None:
    query(name)(lambda spark, folder: _judge_regressor(spark, folder, build()))


def _registered(name: str) -> Fit:
    """A classifier with the sizes of the registry."""
    return registry.build("classification", name)


_classifier("q_clf_logistic", lambda: _registered("Logistic Regression"))
_classifier("q_clf_ridge", lambda: _registered("Ridge Classifier"))
_classifier("q_clf_tree", lambda: _registered("Decision Tree"))
_classifier("q_clf_forest", lambda: _registered("Random Forest"))
_classifier("q_clf_gbt", lambda: _registered("Gradient Boosting"))
_classifier("q_clf_adaboost", lambda: _registered("AdaBoost"))
_classifier("q_clf_bagging", lambda: _registered("Bagging Classifier"))
_classifier("q_clf_rff_svc", lambda: _registered("SVC (RBF Kernel)"))
_classifier("q_clf_linear_svc", lambda: _registered("SVC (Linear Kernel)"))
_classifier("q_clf_mlp", lambda: registry.build("classification", "MLP Classifier (Neural Net)",
                                                "MLPClassifier(hidden_layer_sizes=(50, 50), max_iter=500, early_stopping=True)"))

# regressors on all lines: rounds, trees and depths are reduced, see the README
_regressor("q_reg_linear", regressors.linear)
_regressor("q_reg_ridge", regressors.ridge)
_regressor("q_reg_ridge_cv", lambda: regressors.cross_validated((0.001, 1.0), 0.0, FOLDS))
_regressor("q_reg_lasso", regressors.lasso)
_regressor("q_reg_elasticnet", regressors.elastic_net)
_regressor("q_reg_elasticnet_cv", lambda: regressors.cross_validated((0.001, 1.0), 0.5, FOLDS))
_regressor("q_reg_bayes_ridge", regressors.bayesian_ridge)
_regressor("q_reg_tree", lambda: regressors.tree(8))
_regressor("q_reg_forest", lambda: regressors.forest(10, 8))
_regressor("q_reg_gbt", lambda: regressors.boosting("gradient", maxIter=10))
_regressor("q_reg_gbt_histogram", lambda: regressors.boosting("histogram", maxIter=5))
_regressor("q_reg_gbt_depthwise", lambda: regressors.boosting("depthwise", maxIter=5))
_regressor("q_reg_gbt_leafwise", lambda: regressors.boosting("leafwise", maxIter=5))
_regressor("q_reg_gbt_symmetric", lambda: regressors.boosting("symmetric", maxIter=5))
_regressor("q_reg_adaboost", lambda: regressors.adaboost(4))
_regressor("q_reg_rff_huber", lambda: regressors.rff_huber(30))
_regressor("q_reg_huber", regressors.huber)
_regressor("q_reg_poly2", regressors.polynomial)


_TRAIN = f"substr(md5('42|' || {LINE_KEY_SQL}), 1, 8) >= '33333333'"
_CODED = f"""
    coded AS (SELECT row_number() OVER () AS rid, {', '.join(LINE_KEY)}, l_quantity AS a, l_extendedprice / 1000 AS b, l_discount, l_tax,
                     CASE l_returnflag WHEN 'R' THEN 1.0::DOUBLE WHEN 'A' THEN 2 ELSE 0 END AS y, {_TRAIN} AS is_train FROM lineitem)"""


def flagged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Three return flags as classes, with two columns of quite different range."""
    lines = table(spark, folder, "lineitem")
    flag = F.when(F.col("l_returnflag") == "R", 1.0).when(F.col("l_returnflag") == "A", 2.0).otherwise(0.0)
    rows = lines.select(*LINE_KEY, F.col("l_quantity").alias("a"), (F.col("l_extendedprice") / 1000).alias("b"), "l_discount", "l_tax", flag.alias("y"))
    return split.holdout(rows, LINE_KEY, 0.2, 42)


def _predict_lines(spark, folder, columns: list[str], fit: Fit) -> DataFrame:
    rows = features.assemble(flagged_lines(spark, folder), columns)
    return fit(rows.filter(~F.col("is_test")))(rows).select(*LINE_KEY, "yhat")


@query("q_clf_gaussian_nb", f"""
    WITH {_CODED}, s AS (SELECT y, count(*) AS n, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS va, var_pop(b) AS vb FROM coded WHERE is_train GROUP BY y),
    e AS (SELECT 1e-9 * greatest(var_pop(a), var_pop(b)) AS eps FROM coded WHERE is_train),
    l AS (SELECT c.rid, {', '.join('c.' + k for k in LINE_KEY)}, s.y AS yhat,
                 ln(n::DOUBLE / (SELECT sum(n) FROM s))
                 - 0.5 * ln(2 * pi() * (va + eps)) - (a - ma) * (a - ma) / (2 * (va + eps)) - 0.5 * ln(2 * pi() * (vb + eps)) - (b - mb) * (b - mb) / (2 * (vb + eps)) AS score
          FROM coded c, s, e)
    SELECT {', '.join(LINE_KEY)}, yhat FROM l QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, yhat) = 1""")
def clf_gaussian_nb(spark, folder):
    return _predict_lines(spark, folder, ["a", "b"], classifiers.gaussian_nb())


@query("q_clf_bernoulli_nb", f"""
    WITH {_CODED}, bits AS (SELECT *, (l_discount > 0)::INT AS d, (l_tax > 0)::INT AS t FROM coded),
    s AS (SELECT y, count(*) AS n, (sum(d) + 1.0) / (count(*) + 2) AS pd, (sum(t) + 1.0) / (count(*) + 2) AS pt FROM bits WHERE is_train GROUP BY y),
    l AS (SELECT c.rid, {', '.join('c.' + k for k in LINE_KEY)}, s.y AS yhat,
                 ln(n::DOUBLE / (SELECT sum(n) FROM s)) + ln(CASE d WHEN 1 THEN pd ELSE 1 - pd END) + ln(CASE t WHEN 1 THEN pt ELSE 1 - pt END) AS score
          FROM bits c, s)
    SELECT {', '.join(LINE_KEY)}, yhat FROM l QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, yhat) = 1""")
def clf_bernoulli_nb(spark, folder):
    return _predict_lines(spark, folder, ["l_discount", "l_tax"], classifiers.bernoulli_nb())


def _discriminant_sql(pooled: bool) -> str:
    per_class = """s AS (SELECT y, count(*) AS n, avg(a) AS ma, avg(b) AS mb, var_pop(a) * count(*) AS saa, var_pop(b) * count(*) AS sbb,
                              covar_pop(a, b) * count(*) AS sab FROM coded WHERE is_train GROUP BY y)"""
    if pooled:
        covs = "v AS (SELECT y, n, ma, mb, sum(saa) OVER () / (sum(n) OVER () - count(*) OVER ()) AS vaa, sum(sbb) OVER () / (sum(n) OVER () - count(*) OVER ()) AS vbb, sum(sab) OVER () / (sum(n) OVER () - count(*) OVER ()) AS vab FROM s)"
    else:
        covs = "v AS (SELECT y, n, ma, mb, saa / (n - 1) AS vaa, sbb / (n - 1) AS vbb, sab / (n - 1) AS vab FROM s)"
    return f"""
    WITH {_CODED}, {per_class}, {covs},
    l AS (SELECT c.rid, {', '.join('c.' + k for k in LINE_KEY)}, v.y AS yhat,
                 ln(n::DOUBLE / (SELECT sum(n) FROM s)) - 0.5 * ln(vaa * vbb - vab * vab)
                 - 0.5 * (vbb * (a - ma) * (a - ma) - 2 * vab * (a - ma) * (b - mb) + vaa * (b - mb) * (b - mb)) / (vaa * vbb - vab * vab) AS score
          FROM coded c, v)
    SELECT {', '.join(LINE_KEY)}, yhat FROM l QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, yhat) = 1"""


@query("q_clf_qda", _discriminant_sql(False))
def clf_qda(spark, folder):
    return _predict_lines(spark, folder, ["a", "b"], classifiers.discriminant(pooled=False))


@query("q_clf_lda", _discriminant_sql(True))
def clf_lda(spark, folder):
    return _predict_lines(spark, folder, ["a", "b"], classifiers.discriminant(pooled=True))


_PAIR_DISTANCE = "round(sqrt(list_sum(list_transform(list_zip(CAST(q.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])), lambda e: (e[1] - e[2]) * (e[1] - e[2])))), 9)"


def _near_sql(k: int, query_filter: str = "true", ref_filter: str = "true") -> str:
    return f"""
    near AS (SELECT q.vec_id AS query_id, r.vec_id AS ref_id, r.label, {_PAIR_DISTANCE} AS distance FROM embeddings q JOIN embeddings r ON q.vec_id <> r.vec_id
             WHERE {query_filter} AND {ref_filter}
             QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY distance, r.vec_id) <= {k})"""


@query("q_knn_join", f"WITH {_near_sql(5)} SELECT query_id, ref_id, round(distance, 6) AS distance FROM near")
def knn_join(spark, folder):
    vectors = table(spark, folder, "embeddings")
    near = neighbors.knn_join(vectors, vectors, 5, "vec_id", "vec_id", "embedding", "embedding", exclude_self=True)
    return near.select("query_id", "ref_id", F.round("distance", 6).alias("distance"))


@query("q_knn_join_hashed")
def knn_join_hashed(spark, folder):
    vectors = table(spark, folder, "embeddings")
    near = neighbors.hashed_knn_join(vectors, vectors, 5, "vec_id", "vec_id", "embedding", "embedding", exclude_self=True)
    return near.select("query_id", "ref_id", F.round("distance", 6).alias("distance"))


_TEST_VEC, _TRAIN_VEC = ("substr(md5('42|' || q.vec_id), 1, 8) < '33333333'", "substr(md5('42|' || r.vec_id), 1, 8) >= '33333333'")


@query("q_clf_knn", f"""
    WITH {_near_sql(5, _TEST_VEC, _TRAIN_VEC)}, votes AS (SELECT query_id, label, count(*) AS n FROM near GROUP BY ALL)
    SELECT query_id AS row_id, CAST(label AS DOUBLE) AS yhat FROM votes QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY n DESC, label) = 1""")
def clf_knn(spark, folder):
    vectors = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("label").cast("double").alias("y"), _to_vector("embedding").alias("features"))
    rows = split.holdout(vectors, ["row_id"], 0.2, 42)
    return classifiers.knn(5)(rows.filter(~F.col("is_test")))(rows.filter("is_test")).select("row_id", "yhat")


def _to_vector(column: str):
    return array_to_vector(F.col(column).cast("array<double>"))


@query("q_reg_knn", """
    WITH rows AS (SELECT p_partkey AS id, p_size::DOUBLE AS a, length(p_name)::DOUBLE AS b, p_retailprice AS y,
                         substr(md5('42|' || p_partkey), 1, 8) < '33333333' AS is_test FROM part),
    near AS (SELECT q.id AS row_id, r.y FROM rows q JOIN rows r ON q.is_test AND NOT r.is_test
             QUALIFY row_number() OVER (PARTITION BY q.id ORDER BY round(sqrt((q.a - r.a) ** 2 + (q.b - r.b) ** 2), 9), r.id) <= 5)
    SELECT row_id, round(avg(y), 4) AS yhat FROM near GROUP BY row_id""")
def reg_knn(spark, folder):
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("row_id"), F.col("p_size").cast("double").alias("a"), F.length("p_name").cast("double").alias("b"), F.col("p_retailprice").alias("y"))
    rows = split.holdout(features.assemble(parts, ["a", "b"]), ["row_id"], 0.2, 42)
    predicted = regressors.knn(5)(rows.filter(~F.col("is_test")))(rows.filter("is_test"))
    return predicted.select("row_id", F.round("yhat", 4).alias("yhat"))


@query("q_reg_linear_1d", """
    SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept
    FROM lineitem GROUP BY 1""")
def reg_linear_1d(spark, folder):
    fitted = regressors.linear_1d(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice", ("l_returnflag",))
    return fitted.select("l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"))


@query("q_anom_lof", f"""
    WITH {_near_sql(20)}, reach AS (SELECT query_id AS ref_id, max(distance) AS kd FROM near GROUP BY 1),
    dens AS (SELECT query_id, 1 / (avg(greatest(distance, kd)) + 1e-10) AS d FROM near JOIN reach USING (ref_id) GROUP BY 1)
    SELECT n.query_id AS row_id, round(avg(o.d) / any_value(s.d), 6) AS lof
    FROM near n JOIN dens o ON o.query_id = n.ref_id JOIN dens s ON s.query_id = n.query_id GROUP BY 1""")
def anom_lof(spark, folder):
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("v"))
    return anomaly.local_outlier_factor(vectors, 20).select("row_id", F.round("lof", 6).alias("lof"))


@query("q_anom_mahalanobis", f"""
    WITH s AS (SELECT avg(l_quantity) AS ma, avg(l_extendedprice) AS mb, var_pop(l_quantity) AS va, var_pop(l_extendedprice) AS vb,
                      covar_pop(l_quantity, l_extendedprice) AS vab FROM lineitem)
    SELECT {', '.join(LINE_KEY)}, round((vb * (l_quantity - ma) ** 2 - 2 * vab * (l_quantity - ma) * (l_extendedprice - mb) + va * (l_extendedprice - mb) ** 2)
                                        / (va * vb - vab * vab), 5) AS distance2 FROM lineitem, s""")
def anom_mahalanobis(spark, folder):
    rows = features.assemble(table(spark, folder, "lineitem").select(*LINE_KEY, "l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"])
    return anomaly.mahalanobis(rows).select(*LINE_KEY, F.round("distance2", 5).alias("distance2"))


@query("q_anom_envelope")
def anom_envelope(spark, folder):
    rows = features.assemble(table(spark, folder, "events").select("event_id", F.hour("ts").cast("double").alias("hour"), "value"), ["hour", "value"])
    return anomaly.elliptic_envelope(rows, 0.1).select("event_id", "distance2", "is_outlier")


@query("q_anom_iforest")
def anom_iforest(spark, folder):
    events = table(spark, folder, "events").select(F.col("event_id").alias("row_id"), F.hour("ts").cast("double").alias("hour"), "value")
    rows = features.assemble(events, ["hour", "value"])
    return anomaly.isolation_forest(rows).select("row_id", "anomaly_score", "is_outlier")


# 75 fits in one query: the ensembles and networks are smaller than in the registry, see the README
SMALLER = {"Random Forest": {"num_trees": 20, "max_depth": 8}, "Gradient Boosting": {"rounds": 10}, "AdaBoost": {"rounds": 5},
           "Bagging Classifier": {"max_depth": 8}, "SVC (RBF Kernel)": {"max_iter": 10}, "SVC (Linear Kernel)": {"max_iter": 10},
           "MLP Classifier (Neural Net)": {"max_iter": 50, "early_stopping": True}}


@query("q_eval_classification")
def eval_classification(spark, folder):
    """Every classifier of the registry, five runs: one row per model and run."""
    rows = materialize(labeled_documents(spark, folder))  # the texts are read once
    board, _ = harness.evaluate_classification(rows, TEXT_FEATURES, {m: SMALLER.get(m) for m in registry.CLASSIFIERS}, ["row_id"], runs=5)
    return board


@query("q_eval_anomaly")
def eval_anomaly(spark, folder):
    """Every configured detector; the one without a counterpart here is reported as failed."""
    parts = table(spark, folder, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("size"), F.length("p_name").cast("double").alias("name_length"), "p_retailprice")
    models = {"Isolation Forest": "IsolationForest()", "One-Class SVM": "OneClassSVM()", "Local Outlier Factor": "LocalOutlierFactor()",
              "Elliptic Envelope": "EllipticEnvelope()"}
    flags, status = harness.evaluate(parts, "anomaly-detection", {"anomaly-detection": {"models": models}}, ["size", "name_length", "p_retailprice"],
                                     ["p_partkey"])
    return status.select("model", "status").join(flags.groupBy("model").agg(
        F.count("*").alias("rows"), F.count_if("is_outlier").alias("outliers")), "model", "left")


@query("q_eval_regression")
def eval_regression(spark, folder):
    models = {"Linear Regression": "LinearRegression()", "Ridge Regression": "Ridge()", "Decision Tree": {"max_depth": 5}, "Bayesian Ridge": "BayesianRidge()"}
    board, _ = harness.evaluate_regression(priced_lines(spark, folder), PRICE_FEATURES, models, LINE_KEY, runs=2)
    return board


@query("q_model_roundtrip")
def model_roundtrip(spark, folder):
    rows = features.assemble(labeled_documents(spark, folder), TEXT_FEATURES)
    candidate = search.Candidate(("standardize",), "logistic", (("regParam", 0.01),))
    path = scratch_path(spark, "model")
    search.save(search.to_pipeline(candidate, "classification").fit(rows), path)
    return search.load(path).transform(rows).select("row_id", "y", F.col("prediction").alias("yhat"))
