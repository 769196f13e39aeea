"""Classifiers: Spark ML where it has the model, closed forms and loops over Spark jobs where it does not."""

from __future__ import annotations

import math

from pyspark.ml import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.functions.hashing import digest_below
from goldpan.models.base import Fit, Predict, fitted, from_estimator, no_score, second
from goldpan.models.class_tables import choose, class_statistics, square, squared_distance, total, whitened_classes, whitening
from goldpan.models.moments import unpack
from goldpan.operators.features import FourierMap
from goldpan.operators.neighbors import Join, knn_join
from goldpan.session import materialize

CHECKPOINT_ROUNDS = 10


def logistic(max_iter: int = 500, c: float = 1.0) -> Fit:
    def fit(train: DataFrame) -> Predict:
        reg = 1.0 / (c * train.count())
        return from_estimator(LogisticRegression(labelCol="y", maxIter=max_iter, regParam=reg, standardization=False))(train)

    return fit


def ridge(alpha: float = 1.0) -> Fit:
    """Least squares on a -1/+1 label for each class; the largest value decides (ties: the smaller class), without a probability."""

    def fit(train: DataFrame) -> Predict:
        rows = train.count()
        classes = [r["y"] for r in train.select("y").distinct().orderBy("y").collect()]
        # with two classes both fits are mirror images, so the second one decides by its sign
        fitted = classes[1:] if len(classes) == 2 else classes
        models = []
        for c in fitted:
            signed = train.withColumn("y", F.when(F.col("y") == c, 1.0).otherwise(-1.0))
            solver = LinearRegression(labelCol="y", predictionCol=f"_ridge_{len(models)}", regParam=alpha / rows, standardization=False, solver="normal")
            models.append(solver.fit(signed))

        def predict(df: DataFrame) -> DataFrame:
            for model in models:
                df = model.transform(df)
            values = [F.col(f"_ridge_{k}") for k in range(len(models))]
            if len(classes) == 2:
                yhat = F.when(values[0] > 0, F.lit(float(classes[1]))).otherwise(F.lit(float(classes[0])))
            else:
                pairs = F.array(*[F.struct(v.alias("v"), F.lit(-float(c)).alias("c")) for v, c in zip(values, classes, strict=True)])
                yhat = -F.array_max(pairs)["c"]
            return df.withColumn("yhat", yhat).withColumn("score", no_score()).drop(*[f"_ridge_{k}" for k in range(len(models))])

        return predict

    return fit


def tree(max_depth: int = 30, seed: int = 42) -> Fit:
    return from_estimator(DecisionTreeClassifier(labelCol="y", maxDepth=max_depth, seed=seed))


def forest(num_trees: int = 100, max_depth: int = 30, subset: str = "auto", seed: int = 42) -> Fit:
    # each row keeps its nodes: otherwise every task of every pass receives all trees and walks each row down from their roots
    return from_estimator(RandomForestClassifier(
        labelCol="y", numTrees=num_trees, maxDepth=max_depth, featureSubsetStrategy=subset, seed=seed, cacheNodeIds=True,
        checkpointInterval=CHECKPOINT_ROUNDS))


def bagging(num_trees: int = 10, max_depth: int = 30, seed: int = 42) -> Fit:
    """Bootstrapped trees over all features."""
    return forest(num_trees, max_depth, "all", seed)


def boosting(rounds: int = 100, max_depth: int = 3, step: float = 0.1, seed: int = 42) -> Fit:
    """Gradient boosting; more than two classes are trained one against the rest."""

    def fit(train: DataFrame) -> Predict:
        booster = GBTClassifier(labelCol="y", maxIter=rounds, maxDepth=max_depth, stepSize=step, seed=seed,
                                checkpointInterval=CHECKPOINT_ROUNDS)
        several = train.agg(F.max("y")).first()[0] > 1
        return from_estimator(OneVsRest(classifier=booster, labelCol="y") if several else booster)(train)

    return fit


def calibrated(estimator: Estimator) -> Fit:
    """Decision values turned into probabilities by a logistic fit on the training margin."""

    def fit(train: DataFrame) -> Predict:
        model = estimator.fit(train)
        to_vector = VectorAssembler(inputCols=["_margin"], outputCol="_m")

        def margins(df: DataFrame) -> DataFrame:
            out = model.transform(df).withColumn("_margin", second("rawPrediction")).withColumnRenamed("prediction", "yhat")
            return to_vector.transform(out.drop("rawPrediction", "probability"))

        scale = LogisticRegression(labelCol="y", featuresCol="_m").fit(margins(train))

        def predict(df: DataFrame) -> DataFrame:
            out = scale.transform(margins(df)).withColumn("score", second("probability"))
            return out.drop("prediction", "rawPrediction", "probability", "_m", "_margin")

        return predict

    return fit


def linear_svc(c: float = 1.0, max_iter: int = 100) -> Fit:
    def fit(train: DataFrame) -> Predict:
        return calibrated(LinearSVC(labelCol="y", maxIter=max_iter, regParam=1.0 / (c * train.count()), standardization=False))(train)

    return fit


def rff_svc(components: int = 100, gamma: float | None = None, c: float = 1.0, max_iter: int = 100, seed: int = 42) -> Fit:
    """Linear support vectors on random Fourier features: an RBF kernel without a kernel matrix."""

    def fit(train: DataFrame) -> Predict:
        d = train.select(F.size(vector_to_array("features"))).first()[0]
        fourier = FourierMap.draw(d, components, gamma or 1.0 / d, seed)
        estimator = LinearSVC(labelCol="y", featuresCol="rff", maxIter=max_iter, regParam=1.0 / (c * train.count()), standardization=False)
        inner = calibrated(estimator)(fourier.transform(train))
        return lambda df: inner(fourier.transform(df)).drop("rff")

    return fit


def mlp(hidden: tuple[int, ...] = (50, 50), max_iter: int = 500, seed: int = 42, early_stopping: bool = False, validation: float = 0.1,
        patience: int = 10, tolerance: float = 1e-4) -> Fit:
    """A perceptron.  With ``early_stopping`` a ``validation`` share of the rows, drawn by a digest of their features, is kept back, and the
    fit ends when ``patience`` further iterations make the accuracy there no better by ``tolerance``; the best weights count.
    """

    def fit(train: DataFrame) -> Predict:
        d = train.select(F.size(vector_to_array("features"))).first()[0]
        classes = int(train.agg(F.max("y")).first()[0]) + 1

        def network(iterations: int, weights: object | None = None) -> MultilayerPerceptronClassifier:
            made = MultilayerPerceptronClassifier(labelCol="y", layers=[d, *hidden, max(2, classes)], maxIter=iterations, seed=seed)
            return made if weights is None else made.setInitialWeights(weights)

        if not early_stopping:
            return from_estimator(network(max_iter))(train)
        marked = train.withColumn("_kept_back", digest_below(seed, [vector_to_array("features")], validation)).persist()
        rows, judges = marked.filter(~F.col("_kept_back")), marked.filter("_kept_back")
        if judges.isEmpty() or rows.isEmpty():
            marked.unpersist()
            return from_estimator(network(max_iter))(train)
        best, weights, at = None, None, -math.inf
        for done in range(0, max_iter, patience):
            model = network(min(patience, max_iter - done), weights).fit(rows)
            weights = model.weights
            now = model.transform(judges).agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
            better = now > at + tolerance
            if best is None or now > at:
                best, at = model, max(at, now)
            if not better:
                break
        marked.unpersist()
        return fitted(best)

    return fit


def gaussian_nb(smoothing: float = 1e-9) -> Fit:
    """Per-class means and population variances; the largest feature variance times ``smoothing`` is added."""

    def fit(train: DataFrame) -> Predict:
        plain, names = unpack(train, extra=["y"])
        stats = plain.groupBy(F.col("y").cast("double").alias("y")).agg(
            F.count("*").alias("n"), F.array(*[F.avg(c) for c in names]).alias("mean"), F.array(*[F.var_pop(c) for c in names]).alias("var"))
        row = plain.agg(F.count("*"), *[F.var_pop(c) for c in names]).first()
        n, extra = row[0], smoothing * max(row[1:])
        spread = F.transform("var", lambda v: v + F.lit(extra))
        constant = F.log(F.col("n") / F.lit(n)) - total(F.transform("spread", lambda v: F.log(F.lit(2 * math.pi) * v) / 2))
        classes = stats.withColumn("spread", spread).select(
            "y", "mean", constant.alias("constant"), F.transform("spread", lambda v: 1 / (2 * v)).alias("weights"))

        def predict(df: DataFrame) -> DataFrame:
            return choose(df, classes, vector_to_array("features"),
                          lambda c, x: c["constant"] - squared_distance(x, c["mean"], c["weights"]), 2 * len(names))

        return predict

    return fit


def bernoulli_nb(threshold: float = 0.0, alpha: float = 1.0) -> Fit:
    """Features above the threshold count as present; presence shares are smoothed by ``alpha``."""

    def fit(train: DataFrame) -> Predict:
        plain, names = unpack(train, extra=["y"])
        stats = plain.groupBy(F.col("y").cast("double").alias("y")).agg(
            F.count("*").alias("n"), F.array(*[F.count(F.when(F.col(c) > threshold, 1)) for c in names]).alias("present"))
        n = plain.count()
        share = F.transform("present", lambda k: (k + F.lit(alpha)) / (F.col("n") + F.lit(2 * alpha)))
        logs = F.transform("share", lambda s: F.struct(F.log(s).alias("yes"), F.log(1 - s).alias("no")))
        classes = stats.withColumn("share", share).select("y", F.log(F.col("n") / F.lit(n)).alias("constant"), logs.alias("logs"))

        def predict(df: DataFrame) -> DataFrame:
            return choose(df, classes, vector_to_array("features"), lambda c, x: c["constant"] + total(
                F.zip_with(x, c["logs"], lambda v, e: F.when(v > threshold, e["yes"]).otherwise(e["no"]))), 2 * len(names))

        return predict

    return fit


def discriminant(pooled: bool) -> Fit:
    """Quadratic (own covariance per class) or linear (pooled covariance) discriminant analysis."""

    def fit(train: DataFrame) -> Predict:
        plain, names = unpack(train, extra=["y"])
        d = len(names)
        stats = class_statistics(plain, names)
        # the pooled covariance is d x d numbers, whatever the number of classes
        row = stats.agg(F.sum("n"), F.count("*"), *[F.sum(F.get("cov", F.lit(i)) * F.col("n")) for i in range(d * (d + 1) // 2)]).first()
        n, shared = row[0], square(row[2:], d) / max(1, row[0] - row[1])
        prior = F.log(F.col("n") / F.lit(n))
        if pooled:
            rows, _ = whitening(shared)

            def turned(v: Column) -> Column:
                return F.array(*[total(F.zip_with(v, F.array(*map(F.lit, r)), lambda a, b: a * b)) for r in rows.tolist()])

            classes = stats.select("y", prior.alias("constant"), turned(F.col("mean")).alias("mean"))
            return lambda df: choose(df, classes, turned(vector_to_array("features")),
                                     lambda c, x: c["constant"] - squared_distance(x, c["mean"]) / 2, d + 1)
        classes = whitened_classes(stats, d, shared).select("y", "mean", "rows", (prior - F.col("logdet") / 2).alias("constant"))

        def log_score(c: Column, x: Column) -> Column:
            off = F.zip_with(x, c["mean"], lambda a, b: a - b)
            along = F.transform(c["rows"], lambda r: total(F.zip_with(r, off, lambda a, b: a * b)))
            return c["constant"] - total(F.transform(along, lambda a: a * a)) / 2

        return lambda df: choose(df, classes, vector_to_array("features"), log_score, d * (d + 1))

    return fit


def knn(k: int = 5, join: Join = knn_join) -> Fit:
    """Vote of the k nearest training rows; rows carry a unique ``row_id``.  The smaller class wins a tie.

    ``join`` finds the neighbours: exactly, or by hashing (``hashed_knn_join``).
    """

    def fit(train: DataFrame) -> Predict:
        refs = train.select(F.col("row_id").alias("ref_id"), vector_to_array("features").alias("v"), F.col("y").alias("_vote"))

        def predict(df: DataFrame) -> DataFrame:
            asked = df.withColumn("_v", vector_to_array("features"))
            near = join(asked, refs, k, "row_id", "ref_id", "_v", "v").join(refs.select("ref_id", "_vote"), "ref_id")
            # at most k votes per query
            votes = near.groupBy("query_id", "_vote").agg(F.count("*").alias("_n"))
            best = votes.groupBy("query_id").agg(
                F.negative(F.max(F.struct("_n", F.negative("_vote").alias("c")))["c"]).alias("yhat"),
                (F.sum(F.when(F.col("_vote") == 1, F.col("_n")).otherwise(0)) / F.sum("_n")).alias("score"))
            return df.join(best.withColumnRenamed("query_id", "row_id"), "row_id")

        return predict

    return fit


def adaboost(rounds: int = 50, learning_rate: float = 1.0, max_depth: int = 1, seed: int = 42) -> Fit:
    """Discrete boosting of shallow trees: misclassified rows gain weight, better trees get a larger vote."""

    def fit(train: DataFrame) -> Predict:
        classes = int(train.agg(F.max("y")).first()[0]) + 1
        current = train.select("features", "y").withColumn("_w", F.lit(1.0)).persist()
        members: list[tuple] = []
        for i in range(1, rounds + 1):
            member = DecisionTreeClassifier(labelCol="y", weightCol="_w", maxDepth=max_depth, seed=seed).fit(current)
            judged = member.transform(current).withColumn("_miss", (F.col("prediction") != F.col("y")).cast("double"))
            missed, total = judged.agg(F.sum(F.col("_w") * F.col("_miss")), F.sum("_w")).first()
            error = missed / total
            if error >= 1 - 1 / classes:
                break
            vote = learning_rate * (math.log((1 - error) / error) + math.log(classes - 1)) if error > 0 else 1.0
            members.append((member, vote))
            if error == 0:
                break
            grown = judged.withColumn("_w", F.col("_w") * F.exp(F.lit(vote) * F.col("_miss")) / F.lit(total)).select("features", "y", "_w")
            # one pass per round over stored weights; reliable storage cuts the lineage from time to time
            following = materialize(grown) if i % CHECKPOINT_ROUNDS == 0 else grown.persist()
            following.count()
            current.unpersist()
            current = following
        current.unpersist()
        if not members:
            raise ValueError("no tree does better than chance")

        def predict(df: DataFrame) -> DataFrame:
            out = df
            shares = {c: F.lit(0.0) for c in range(classes)}
            total = sum(v for _, v in members)
            for i, (member, vote) in enumerate(members):
                out = member.transform(out).withColumnRenamed("prediction", f"_p{i}").drop("rawPrediction", "probability")
                for c in shares:
                    shares[c] = shares[c] + F.when(F.col(f"_p{i}") == c, vote / total).otherwise(0.0)
            best = F.greatest(*[F.struct(shares[c].alias("s"), F.lit(-float(c)).alias("c")) for c in shares])
            return out.withColumn("yhat", F.negative(best["c"])).withColumn("score", shares.get(1, F.lit(0.0))).drop(
                *[f"_p{i}" for i in range(len(members))])

        return predict

    return fit
