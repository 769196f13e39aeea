import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.sql import functions as F

from goldpan.evaluation import harness
from goldpan.models import anomaly, classifiers, forecast, regressors, registry
from goldpan.operators import features, split
from goldpan.plans import search


@pytest.fixture(scope="module")
def classes(spark):
    """Two classes apart in two of three features."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        y = i % 2
        rows.append((i, *(rng.normal(loc=[2.0 * y - 1, 1.0 - 2.0 * y, 0.0])), float(y)))
    df = features.assemble(spark.createDataFrame([tuple(map(float, r)) for r in rows], "row_id double, a double, b double, c double, y double"), ["a", "b", "c"])
    return split.holdout(df.withColumn("row_id", F.col("row_id").cast("long")), ["row_id"], 0.25).cache()


CLASSIFIERS = {
    "logistic": lambda: classifiers.logistic(50), "ridge": classifiers.ridge, "tree": lambda: classifiers.tree(4), "forest": lambda: classifiers.forest(5, 4),
    "boosting": lambda: classifiers.boosting(3), "adaboost": lambda: classifiers.adaboost(3), "bagging": lambda: classifiers.bagging(3, 4),
    "linear_svc": lambda: classifiers.linear_svc(max_iter=3), "rff_svc": lambda: classifiers.rff_svc(30, max_iter=3), "mlp": lambda: classifiers.mlp((5,), 20),
    "gaussian_nb": classifiers.gaussian_nb, "bernoulli_nb": classifiers.bernoulli_nb, "qda": lambda: classifiers.discriminant(False),
    "lda": lambda: classifiers.discriminant(True), "knn": lambda: classifiers.knn(5)}


@pytest.mark.parametrize("name", CLASSIFIERS)
def test_classifier_beats_the_constant(classes, name):
    out = CLASSIFIERS[name]()(classes.filter("not is_test"))(classes.filter("is_test"))
    row = out.agg(F.avg((F.col("y") == F.col("yhat")).cast("double")), F.count("*"), F.count("score")).first()
    assert row[0] > 0.8 and row[1] == classes.filter("is_test").count()
    assert row[2] == (0 if name == "ridge" else row[1])


def test_gaussian_naive_bayes_agrees_with_spark_ml(classes):
    train = classes.filter("not is_test")
    ours = classifiers.gaussian_nb()(train)(classes).select("row_id", "yhat")
    theirs = NaiveBayes(modelType="gaussian", labelCol="y").fit(train).transform(classes).select("row_id", "prediction")
    assert ours.join(theirs, "row_id").filter("yhat <> prediction").count() == 0


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 2))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 5 + rng.normal(scale=0.1, size=400)
    df = spark.createDataFrame([(i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))], "row_id long, a double, b double, y double")
    return split.folds(split.holdout(features.assemble(df, ["a", "b"]), ["row_id"], 0.25), ["row_id"], 3).cache()


REGRESSORS = {
    "linear": regressors.linear, "ridge": regressors.ridge, "lasso": lambda: regressors.lasso(0.1), "elastic": lambda: regressors.elastic_net(0.1),
    "cv": lambda: regressors.cross_validated((0.001, 1.0), 0.0, 3), "bayes": regressors.bayesian_ridge, "tree": lambda: regressors.tree(6),
    "forest": lambda: regressors.forest(5, 6), "boosting": lambda: regressors.boosting("depthwise", maxIter=5), "adaboost": lambda: regressors.adaboost(3),
    "huber": regressors.huber, "rff_huber": lambda: regressors.rff_huber(60, 0.2), "poly": regressors.polynomial, "knn": lambda: regressors.knn(5)}


@pytest.mark.parametrize("name", REGRESSORS)
def test_regressor_beats_the_mean(numbers, name):
    out = REGRESSORS[name]()(numbers.filter("not is_test"))(numbers.filter("is_test"))
    row = out.agg(F.avg(F.pow(F.col("y") - F.col("yhat"), 2)), F.var_pop("y"), F.count("*")).first()
    assert row[0] < 0.6 * row[1] and row[2] == numbers.filter("is_test").count()


def test_registry_parses_and_refuses():
    assert registry.literal_parameters("MLPClassifier(hidden_layer_sizes=(50,50), max_iter=500, early_stopping=True)") == {
        "hidden_layer_sizes": (50, 50), "max_iter": 500, "early_stopping": True}
    with pytest.raises(ValueError, match="literal"):
        registry.literal_parameters("Model(x=__import__('os'))")
    with pytest.raises(ValueError, match="unknown problem"):
        registry.build("clustering", "x")
    with pytest.raises(ValueError, match="no classification model"):
        registry.build("classification", "Perceptron", "Perceptron()")
    assert callable(registry.build("classification", "Logistic Regression", "LogisticRegression(max_iter=500)"))


@pytest.mark.parametrize(("problem", "name", "text", "ours"), [
    ("classification", "Random Forest", "RandomForestClassifier(n_estimators=500, max_depth=None)", {"num_trees": 500}),
    ("classification", "AdaBoost", "AdaBoostClassifier(n_estimators=200, learning_rate=0.1)", {"rounds": 200, "learning_rate": 0.1}),
    ("classification", "Gaussian Naive Bayes", "GaussianNB(var_smoothing=0.1)", {"smoothing": 0.1}),
    ("classification", "SVC (RBF Kernel)", "SVC(kernel='rbf', probability=True)", {}),
    ("regression", "Gradient Boosting", "GradientBoostingRegressor(n_estimators=300, max_depth=7, learning_rate=0.01)",
     {"maxIter": 300, "maxDepth": 7, "stepSize": 0.01}),
    ("regression", "XGBoost", "XGBRegressor(max_depth=9)", {"maxDepth": 9}),
    ("regression", "CatBoost", "CatBoostRegressor(verbose=0)", {}),
])
def test_configured_parameters_take_effect(spark, problem, name, text, ours):
    assert registry.translated(problem, name, registry.literal_parameters(text)) == ours
    assert callable(registry.build(problem, name, text))


def test_parameters_without_effect_are_refused():
    for name, text in (("Logistic Regression", "LogisticRegression(penalty='l1')"), ("SVC (RBF Kernel)", "SVC(kernel='poly')")):
        with pytest.raises(ValueError, match="without effect"):
            registry.build("classification", name, text)


def test_evaluation_reports_failures_and_ranks(classes):
    df = classes.drop("features", "is_test").withColumnRenamed("y", "Target")

    def broken(train):
        raise RuntimeError("no luck")

    config = {"classification": {"target_col": "Target", "Golden Score": {"F1": 0.4, "Accuracy": 0.25, "Precision": 0.15, "Recall": 0.10, "ROC-AUC": 0.10},
                                 "models": {"Linear Discriminant Analysis": "LinearDiscriminantAnalysis()", "Perceptron": "Perceptron()", "broken": broken}}}
    board, status = harness.evaluate(df, "classification", config, ["a", "b", "c"], ["row_id"], runs=2, fit_on="all")
    assert [(r["rank"], r["model"]) for r in board.collect()] == [(1, "Linear Discriminant Analysis"), (2, "Linear Discriminant Analysis")]
    assert {(r["model"], r["status"]) for r in status.collect()} == {("Linear Discriminant Analysis", "ok"), ("Perceptron", "failed"), ("broken", "failed")}
    with pytest.raises(ValueError, match="invalid problem type"):
        harness.evaluate(df, "clustering", config)
    with pytest.raises(ValueError, match="not configured"):
        harness.evaluate(df, "anomaly-detection", config)
    with pytest.raises(ValueError, match="date column"):
        harness.evaluate(df, "time-series", {"time-series": {"Golden Score": {"MAE": 1.0}, "models": {}}})


def test_detectors_find_the_planted_outlier(spark):
    rng = np.random.default_rng(4)
    points = [(i, [float(a), float(b)]) for i, (a, b) in enumerate(rng.normal(size=(200, 2)))] + [(999, [8.0, -8.0])]
    df = spark.createDataFrame(points, "row_id long, v array<double>").select("row_id", "v", F.get("v", F.lit(0)).alias("a"), F.get("v", F.lit(1)).alias("b"))
    rows = features.assemble(df, ["a", "b"])
    top = anomaly.isolation_forest(rows, 20).orderBy(F.desc("anomaly_score")).first()
    assert top["row_id"] == 999 and top["is_outlier"]
    assert anomaly.local_outlier_factor(df, 10).orderBy(F.desc("lof")).first()["row_id"] == 999
    flagged = anomaly.elliptic_envelope(rows, 0.05)
    assert flagged.orderBy(F.desc("distance2")).first()["row_id"] == 999 and 5 <= flagged.filter("is_outlier").count() <= 15


@pytest.fixture(scope="module")
def seasons(spark):
    """Two years of a weekly pattern on a rising trend, and a series too short for a season."""
    rng = np.random.default_rng(6)
    t = np.arange(300)
    y = 0.1 * t + 10 * np.sin(2 * np.pi * t / 12) + rng.normal(scale=0.3, size=300)
    rows = [("long", int(i), float(v)) for i, v in zip(t, y)] + [("short", i, 5.0) for i in range(4)]
    return spark.createDataFrame(rows, "series_id string, i int, y double").select("series_id", F.expr("date_add(date'2023-01-01', i)").alias("ds"), "y").cache()


def test_forecasters_beat_the_last_value(seasons):
    known = seasons.filter("ds < date'2023-01-01' + interval '276' day")
    truth = [r["y"] for r in seasons.filter("series_id = 'long' and ds >= date'2023-01-01' + interval '276' day").orderBy("ds").collect()]
    last = known.filter("series_id = 'long'").orderBy(F.desc("ds")).first()["y"]
    naive = np.mean(np.abs(np.array(truth) - last))
    for fn in (lambda: forecast.autoregression(known, 24), lambda: forecast.seasonal(known, 24)):
        out = fn()
        values = [r["yhat"] for r in out.filter("series_id = 'long'").orderBy("step").collect()]
        assert len(values) == 24 and np.mean(np.abs(np.array(truth) - values)) < naive
        assert all(abs(r["yhat"] - 5.0) < 1e-9 for r in out.filter("series_id = 'short'").collect())


def test_decomposition_follows_trend_and_week(spark):
    t = np.arange(200)
    y = 100 + 0.5 * t + 7 * ((t % 7) == 0)
    history = spark.createDataFrame([("s", int(i), float(v)) for i, v in zip(t, y)], "series_id string, i int, y double").select(
        "series_id", F.expr("date_add(date'2024-01-01', i)").alias("ds"), "y")
    model = forecast.Decomposition()
    train = history.filter("ds < date'2024-01-01' + interval '186' day")
    out = model.predict(model.fit(train), history.select("series_id", "ds")).join(history, ["series_id", "ds"])
    row = out.filter("ds >= date'2024-01-01' + interval '186' day").agg(F.avg(F.abs(F.col("y") - F.col("yhat"))), F.count("*")).first()
    assert row[1] == 14 and row[0] < 2.0


def test_time_series_evaluation(seasons):
    board, status = harness.evaluate_time_series(seasons.filter("series_id = 'long'"), ["ARIMA", "SARIMA", "Nothing"])
    assert {r["model"]: r["status"] for r in status.collect()} == {"ARIMA": "ok", "SARIMA": "ok", "Nothing": "failed"}
    assert [r["rank"] for r in board.collect()] == [1, 2]


def test_search_is_repeatable_and_ranked(spark, classes):
    assert search.draw_candidates("classification", 6) == search.draw_candidates("classification", 6)
    assert len(set(search.draw_candidates("regression", 8))) == 8
    scored = search.search(classes.select("row_id", "features", "y"), "classification", ["row_id"], 2, 2)
    assert [o.status for o in scored] == ["ok", "ok"] and scored[0].cv_mean >= scored[1].cv_mean and scored[0].cv_mean > 0.8
    table = search.ranking(spark, scored).collect()
    assert table[0]["cv_mean"] == scored[0].cv_mean and table[0]["depth"] == len(table[0]["stages"])


def test_saved_pipeline_predicts_the_same(spark, classes, tmp_path):
    candidate = search.Candidate(("standardize",), "logistic", (("regParam", 0.01),))
    model = search.to_pipeline(candidate, "classification").fit(classes)
    search.save(model, str(tmp_path / "m"))
    again = search.load(str(tmp_path / "m"))
    a = [r[0] for r in model.transform(classes).orderBy("row_id").select("prediction").collect()]
    assert a == [r[0] for r in again.transform(classes).orderBy("row_id").select("prediction").collect()]


def test_stage_usage(spark):
    df = spark.createDataFrame([("A(B(input), x=1)", 0.5), ("A(A(input))", 0.9), ("B(input)", 0.1)], "pipeline string, cv_mean double")
    out = {r["stage"]: tuple(r)[1:] for r in search.stage_usage(df).collect()}
    assert out == {"A": (2, 3, 2, 0.9), "B": (2, 2, 1, 0.1)}
    assert [r["depth"] for r in search.nesting(df).collect()] == [2, 2, 1]


def test_trend_and_seasons_equal_a_fit_on_the_whole_design(spark):
    """Products summed per task and merged give what one task with all design rows gives."""
    rng = np.random.default_rng(5)
    rows = []
    for name in ("a", "b", "c", "zero"):
        for i in range(150):
            y = None if i % 17 == 3 else 0.0 if name == "zero" else 50 + 0.3 * i + 5 * np.sin(i / 3) + rng.normal()
            rows.append((name, i, None if y is None else float(y), float(rng.normal())))
    df = spark.createDataFrame(rows, "series_id string, i int, y double, r double").selectExpr(
        "series_id", "date_add(date'2024-01-01', i) AS ds", "y", "r").repartition(5)
    model = forecast.Decomposition(changepoints=5, yearly=2, regressors=("r",))
    facts, betas = model.fit(df)
    design = model.design(df.where("y is not null"), facts).toPandas()
    penalties = np.array([1.0 / s**2 for _, _, s in model.columns()])
    for name, found in {r["series_id"]: r["beta"] for r in betas.collect()}.items():
        own = design[design["series_id"] == name]
        x, y = np.stack(own["x"]), own["y"].to_numpy()
        scale = np.abs(y).max() or 1.0
        noise = 1e-2
        for _ in range(3):
            beta = np.linalg.solve(x.T @ x + np.diag(noise * penalties) + 1e-9 * np.eye(x.shape[1]), x.T @ (y / scale))
            noise = max(float(np.mean((y / scale - x @ beta) ** 2)), 1e-8)
        assert np.allclose(x @ np.array(found), x @ beta * scale, rtol=1e-6, atol=1e-6)


def test_trend_and_seasons_shuffle_no_design_rows(spark):
    import io
    from contextlib import redirect_stdout

    df = spark.createDataFrame([("a", i, float(i)) for i in range(50)], "series_id string, i int, y double").selectExpr(
        "series_id", "date_add(date'2024-01-01', i) AS ds", "y")
    model = forecast.Decomposition(changepoints=3, yearly=1)
    plans = []
    kept = forecast.materialize
    forecast.materialize = lambda d: plans.append(d) or kept(d)
    try:
        model.fit(df)
    finally:
        forecast.materialize = kept
    out = io.StringIO()
    with redirect_stdout(out):
        plans[0].explain("formatted")
    text = out.getvalue()
    for part in text.split("\n\n"):
        if ") Exchange" in part:
            given = part[part.index("Input ["):]
            assert " x#" not in given and "[x#" not in given


def test_short_series_continue_by_autoregression_and_say_so(spark):
    rows = [("long", i, 10 + i + 3 * np.sin(i * np.pi / 6)) for i in range(80)] + [("short", i, 5.0 + 2 * i) for i in range(20)] + [("one", 0, 7.0)]
    df = spark.createDataFrame([(s, i, float(y)) for s, i, y in rows], "series_id string, ds int, y double")
    out = forecast.seasonal(df, 4)
    assert {r[0]: r[1] for r in out.select("series_id", "status").distinct().collect()} == {
        "long": "seasonal", "short": "autoregression", "one": "autoregression"}
    short = [r["yhat"] for r in out.where("series_id = 'short'").orderBy("step").collect()]
    assert np.allclose(short, [45, 47, 49, 51])
    assert [r["yhat"] for r in out.where("series_id = 'one'").collect()] == [7.0] * 4


def test_series_without_both_parts_are_reported(spark):
    rows = [("a", i, float(i % 7)) for i in range(60)] + [("b", 0, 1.0)]
    df = spark.createDataFrame(rows, "series_id string, ds int, y double")
    _, status = harness.evaluate_time_series(df, ["ARIMA"])
    found = [tuple(r) for r in status.collect()]
    assert ("time-series", "ARIMA", 0, "ok", None) in found and any("series b" in (r[4] or "") and r[3] == "skipped" for r in found)


def test_rows_without_a_prediction_count_nowhere(spark):
    from goldpan.evaluation import metrics

    df = spark.createDataFrame([("g", 1.0, 1.5), ("g", 2.0, 2.0), ("g", 99.0, None)], "part string, y double, yhat double")
    row = metrics.regression_metrics(df, ["part"]).first()
    assert row["test_mse"] == pytest.approx(0.125) and row["test_r2"] == pytest.approx(0.5)


def test_anomaly_detection_by_configuration(spark):
    rng = np.random.default_rng(8)
    rows = [(i, *map(float, rng.normal(size=2))) for i in range(200)] + [(999, 12.0, -12.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    config = {"anomaly-detection": {"models": {
        "Isolation Forest": "IsolationForest(n_estimators=20)", "One-Class SVM": "OneClassSVM()", "Local Outlier Factor": "LocalOutlierFactor(n_neighbors=10)",
        "Elliptic Envelope": "EllipticEnvelope(contamination=0.05)", "Wrong": "Wrong(x=1)"}}}
    flags, status = harness.evaluate(df, "anomaly-detection", config, ["a", "b"], ["id"])
    assert {r["model"]: r["status"] for r in status.collect()} == {
        "Isolation Forest": "ok", "One-Class SVM": "failed", "Local Outlier Factor": "ok", "Elliptic Envelope": "ok", "Wrong": "failed"}
    found = flags.toPandas()
    assert len(found) == 3 * 201
    for _, own in found.groupby("model"):
        assert own.loc[own["score"].idxmax(), "row_id"] == 999 and own.set_index("row_id").loc[999, "is_outlier"]
    with pytest.raises(ValueError, match="one key column"):
        harness.evaluate(df, "anomaly-detection", config, ["a", "b"])


def test_early_stopping_ends_the_fit_and_keeps_the_best_weights(classes, monkeypatch):
    train, test = classes.filter("not is_test"), classes.filter("is_test")
    rounds = []
    original = classifiers.MultilayerPerceptronClassifier

    def counted(**options):
        rounds.append(options["maxIter"])
        return original(**options)

    monkeypatch.setattr(classifiers, "MultilayerPerceptronClassifier", counted)
    fit = registry.build("classification", "MLP Classifier (Neural Net)", "MLPClassifier(hidden_layer_sizes=(5,), max_iter=500, early_stopping=True)")
    out = fit(train)(test)
    assert out.where("y = yhat").count() > 0.8 * test.count()
    assert 1 < len(rounds) < 20 and set(rounds) == {10}
