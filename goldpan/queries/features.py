"""Feature preparation, holdouts and folds."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.operators import features, split, stages
from goldpan.queries.registry import query, table

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LINE_KEY_SQL = "l_orderkey || '|' || l_partkey || '|' || l_suppkey || '|' || l_linenumber"
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(*LINE_KEY, *LINE_FEATURES, "l_returnflag")


def spread(df: DataFrame, vector: str, n: int, keys: list[str]) -> DataFrame:
    """First ``n`` components of a vector column, rounded, as plain columns."""
    values = vector_to_array(vector)
    return df.select(*keys, *[F.round(F.get(values, F.lit(i)), 4).alias(f"f{i}") for i in range(n)])


def _scaled_sql(center: str, width: str) -> str:
    stats = ", ".join(f"{center.format(c=c)} AS a_{c}, {width.format(c=c)} AS b_{c}" for c in LINE_FEATURES)
    scaled = ", ".join(f"round(CASE WHEN b_{c} = 0 THEN 0 ELSE ({c} - a_{c}) / b_{c} END, 4) + 0.0 AS {c}" for c in LINE_FEATURES)
    return f"WITH s AS (SELECT {stats} FROM lineitem) SELECT {', '.join(LINE_KEY)}, {scaled} FROM lineitem, s"


def _scaled(df: DataFrame, scale: features.LinearScale) -> DataFrame:
    return scale.transform(df).select(*LINE_KEY, *[(F.round(c, 4) + 0.0).alias(c) for c in LINE_FEATURES])


@query("q_standardize", _scaled_sql("avg({c})", "stddev_pop({c})"))
def standardize(spark, folder):
    rows = lines(spark, folder)
    return _scaled(rows, features.fit_standard(rows, LINE_FEATURES))


@query("q_minmax_features", _scaled_sql("min({c})", "max({c}) - min({c})"))
def minmax_features(spark, folder):
    rows = lines(spark, folder)
    return _scaled(rows, features.fit_minmax(rows, LINE_FEATURES))


@query("q_robust_scale", _scaled_sql("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"))
def robust_scale(spark, folder):
    rows = lines(spark, folder)
    return _scaled(rows, features.fit_robust(rows, LINE_FEATURES))


@query("q_holdout", """
    SELECT o_orderkey, substr(md5('42|' || o_orderkey), 1, 8) < '33333333' AS is_test FROM orders""")
def holdout(spark, folder):
    return split.holdout(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 0.2, 42)


@query("q_holdout_exact", """
    SELECT o_orderkey, row_number() OVER (ORDER BY md5('42|' || o_orderkey)) <= (SELECT ceil(count(*) * 0.2) FROM orders) AS is_test FROM orders""")
def holdout_exact(spark, folder):
    return split.exact_holdout(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 0.2, 42)


@query("q_stratified_holdout", f"""
    SELECT {', '.join(LINE_KEY)}, l_returnflag,
           row_number() OVER (PARTITION BY l_returnflag ORDER BY md5('42|' || {LINE_KEY_SQL}))
             <= ceil(count(*) OVER (PARTITION BY l_returnflag) * 0.2) AS is_test
    FROM lineitem""")
def stratified_holdout(spark, folder):
    return split.exact_holdout(lines(spark, folder).select(*LINE_KEY, "l_returnflag"), LINE_KEY, 0.2, 42, ["l_returnflag"])


@query("q_repeated_holdout", """
    SELECT o_orderkey, CAST(run AS INTEGER) AS run, substr(md5(run || '|' || o_orderkey), 1, 8) < '33333333' AS is_test
    FROM orders, (SELECT unnest(range(0, 5)) AS run)""")
def repeated_holdout(spark, folder):
    return split.repeated_holdout(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 0.2, 5)


@query("q_search_folds", """
    SELECT o_orderkey, CAST(CAST('0x' || substr(md5('42|' || o_orderkey), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold FROM orders""")
def search_folds(spark, folder):
    return split.folds(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 5, 42)


@query("q_polynomial", f"""
    SELECT {', '.join(LINE_KEY)}, round(l_quantity, 4) AS f0, round(l_quantity * l_quantity, 4) AS f1, round(l_discount, 4) AS f2,
           round(l_quantity * l_discount, 4) AS f3, round(l_discount * l_discount, 4) AS f4
    FROM lineitem""")
def polynomial(spark, folder):
    rows = features.assemble(lines(spark, folder), ["l_quantity", "l_discount"])
    return spread(features.polynomial(2).transform(rows), "poly", 5, LINE_KEY)


@query("q_binarize", f"""
    SELECT {', '.join(LINE_KEY)}, CASE WHEN l_discount > 0.05 THEN 1.0::DOUBLE ELSE 0 END AS l_discount, CASE WHEN l_tax > 0.05 THEN 1.0::DOUBLE ELSE 0 END AS l_tax FROM lineitem""")
def binarize(spark, folder):
    return features.binarize(lines(spark, folder).select(*LINE_KEY, "l_discount", "l_tax"), ["l_discount", "l_tax"], 0.05)


@query("q_onehot_minfrac", """
    WITH s AS (SELECT p_type, count(*) / (SELECT count(*) FROM part) >= 0.16 AS kept FROM part GROUP BY 1)
    SELECT p_partkey, CAST(CASE WHEN kept THEN p_type ELSE 'other' END AS VARCHAR) AS kind FROM part JOIN s USING (p_type)""")
def onehot_minfrac(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_type")
    coded = features.onehot_minimum_fraction(parts, "p_type", 0.16)
    flags = [c for c in coded.columns if c.startswith("is_") and c != "is_other"]
    # back from indicator columns to the value, which the check can compare whatever values are kept
    kind = F.coalesce(*[F.when(F.col(c) == 1, F.upper(F.lit(c[3:]))) for c in flags], F.when(F.col("is_other") == 1, "other"))
    return coded.select("p_partkey", kind.alias("kind"))


@query("q_onehot_fitted", """
    WITH parts AS (SELECT p_partkey, p_type, substr(md5('42|' || p_partkey), 1, 8) < '33333333' AS is_test FROM part),
    kept AS (SELECT p_type FROM parts WHERE NOT is_test GROUP BY 1 HAVING count(*) >= 0.16 * (SELECT count(*) FROM parts WHERE NOT is_test)),
    ranked AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS place FROM kept)
    SELECT p_partkey, CAST(coalesce(place, (SELECT count(*) FROM kept)) AS BIGINT) AS place FROM parts LEFT JOIN ranked USING (p_type) WHERE is_test""")
def onehot_fitted(spark, folder):
    """Values frequent among the training rows, applied to the test rows: the place of the one in each vector."""
    parts = split.holdout(table(spark, folder, "part").select("p_partkey", "p_type"), ["p_partkey"], 0.2, 42)
    encoder = stages.FrequentOneHot(inputCol="p_type", outputCol="kind", minimumFraction=0.16).fit(parts.filter(~F.col("is_test")))
    coded = encoder.transform(parts.filter("is_test"))
    return coded.select("p_partkey", (F.array_position(vector_to_array("kind"), 1.0) - 1).alias("place"))


@query("q_zero_count", f"""
    SELECT {', '.join(LINE_KEY)}, CAST((l_discount = 0)::INT + (l_tax = 0)::INT + (l_quantity = 0)::INT AS INTEGER) AS n_zero,
           CAST(3 - ((l_discount = 0)::INT + (l_tax = 0)::INT + (l_quantity = 0)::INT) AS INTEGER) AS n_nonzero FROM lineitem""")
def zero_count(spark, folder):
    return features.zero_counts(lines(spark, folder), ["l_discount", "l_tax", "l_quantity"]).select(*LINE_KEY, "n_zero", "n_nonzero")


@query("q_variance_select", f"""
    SELECT {', '.join(LINE_KEY)}, round(l_quantity, 4) AS f0, round(l_extendedprice, 4) AS f1 FROM lineitem
    WHERE (SELECT var_samp(l_quantity) > 1 AND var_samp(l_extendedprice) > 1 AND var_samp(l_discount) <= 1 AND var_samp(l_tax) <= 1 FROM lineitem)""")
def variance_select(spark, folder):
    rows = features.assemble(lines(spark, folder), LINE_FEATURES)
    return spread(features.variance_selector(1.0).fit(rows).transform(rows), "selected", 2, LINE_KEY)


def priced_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Regression rows: the charge of a line from its quantity, price, discount, tax and the retail price of the part."""
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    rows = table(spark, folder, "lineitem").select(*LINE_KEY, *LINE_FEATURES, charge.alias("y"))
    return rows.join(parts, "l_partkey")


PRICE_FEATURES = [*LINE_FEATURES, "p_retailprice"]


@query("q_univariate_select")
def univariate_select(spark, folder):
    rows = features.assemble(priced_lines(spark, folder), PRICE_FEATURES)
    kept = []
    for mode, threshold in (("percentile", 0.5), ("fwe", 0.01)):
        chosen = features.univariate_selector(mode, threshold, categorical_label=False).fit(rows).selectedFeatures
        kept += [(mode, PRICE_FEATURES[i]) for i in chosen]
    return spark.createDataFrame(kept, "mode string, feature string")


def _parts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training and test rows."""
    marked = split.holdout(df, LINE_KEY, 0.2, 42)
    return marked.filter(~F.col("is_test")), marked.filter("is_test")


@query("q_rfe")
def rfe(spark, folder):
    train, test = _parts(features.assemble(priced_lines(spark, folder), PRICE_FEATURES))
    forest = RandomForestRegressor(labelCol="y", numTrees=100, maxDepth=5, seed=42)
    fitted = stages.EliminateFeatures(inputCol="features", outputCol="selected", keep=2, inner=forest).fit(train)
    return spread(fitted.transform(test), "selected", 2, LINE_KEY)


@query("q_select_from_model")
def select_from_model(spark, folder):
    rows = lines(spark, folder).withColumn("y", (F.col("l_returnflag") == "R").cast("double"))
    train, test = _parts(features.assemble(rows, LINE_FEATURES))
    forest = RandomForestClassifier(labelCol="y", numTrees=100, maxDepth=5, seed=42)
    fitted = stages.SelectByImportance(inputCol="features", outputCol="selected", inner=forest).fit(train)
    return spread(fitted.transform(test), "selected", len(fitted.getOrDefault(fitted.places)), LINE_KEY)


@query("q_pca")
def pca(spark, folder):
    rows = lines(spark, folder)
    scaled = features.fit_standard(rows, LINE_FEATURES).transform(rows)
    vectors = features.assemble(scaled, LINE_FEATURES)
    return spread(features.pca(2).fit(vectors).transform(vectors), "pca", 2, LINE_KEY)


def _scaled_vectors(spark, folder) -> DataFrame:
    rows = lines(spark, folder)
    return features.assemble(features.fit_standard(rows, LINE_FEATURES).transform(rows), LINE_FEATURES)


def _fourier_sql(components: int, gamma: float) -> str:
    """The drawn weights and phases as literals."""
    drawn = features.FourierMap.draw(len(LINE_FEATURES), components, gamma)
    stats = ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS b_{c}" for c in LINE_FEATURES)
    maps = []
    for i, (w, b) in enumerate(zip(drawn.weights, drawn.phases, strict=True)):
        turn = " + ".join(f"(({c} - a_{c}) / b_{c}) * ({float(v)!r})::DOUBLE" for c, v in zip(LINE_FEATURES, w, strict=True))
        maps.append(f"round({(2.0 / components) ** 0.5!r}::DOUBLE * cos({turn} + ({float(b)!r})::DOUBLE), 4) + 0.0 AS f{i}")
    return f"WITH s AS (SELECT {stats} FROM lineitem) SELECT {', '.join(LINE_KEY)}, {', '.join(maps)} FROM lineitem, s"


@query("q_rff", _fourier_sql(16, 0.5))
def rff(spark, folder):
    mapped = features.FourierMap.draw(len(LINE_FEATURES), 16, gamma=0.5).transform(_scaled_vectors(spark, folder))
    rounded = spread(mapped, "rff", 16, LINE_KEY)
    return rounded.select(*LINE_KEY, *[(F.col(f"f{i}") + 0.0).alias(f"f{i}") for i in range(16)])


@query("q_nystroem")
def nystroem(spark, folder):
    rows = _scaled_vectors(spark, folder)
    return spread(features.NystroemMap.fit(rows, LINE_KEY, 16, gamma=0.5).transform(rows), "nystroem", 16, LINE_KEY)


@query("q_feature_union", f"""
    SELECT {', '.join(LINE_KEY)}, round(l_quantity, 4) AS f0, round(l_discount, 4) AS f1, round(l_quantity, 4) AS f2,
           round(l_quantity * l_quantity, 4) AS f3, round(l_discount, 4) AS f4, round(l_quantity * l_discount, 4) AS f5,
           round(l_discount * l_discount, 4) AS f6, round(l_tax, 4) AS f7 FROM lineitem""")
def feature_union(spark, folder):
    rows = features.assemble(lines(spark, folder), ["l_quantity", "l_discount"], "plain")
    branches = features.polynomial(2, "plain", "poly").transform(rows)
    return spread(features.union_features(branches, ["plain", "poly", "l_tax"]), "features", 8, LINE_KEY)


# the normal equations of charge on quantity, from the training rows
@query("q_stacking", f"""
    WITH marked AS (SELECT {', '.join(LINE_KEY)}, l_quantity AS x, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS y,
                           substr(md5('42|' || {LINE_KEY_SQL}), 1, 8) < '33333333' AS is_test FROM lineitem),
    line AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM marked WHERE NOT is_test)
    SELECT {', '.join(LINE_KEY)}, round(x, 4) AS f0, round(a * x + b, 4) AS f1 FROM marked, line WHERE is_test""")
def stacking(spark, folder):
    train, test = _parts(features.assemble(priced_lines(spark, folder), ["l_quantity"]))
    inner = LinearRegression(labelCol="y", solver="normal")
    return spread(stages.StackedPrediction(inputCol="features", outputCol="stacked", inner=inner).fit(train).transform(test), "stacked", 2, LINE_KEY)
