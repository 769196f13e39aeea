"""Projections, predicates, group counts, sorts and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldpan.operators import columns, grouping
from goldpan.queries.registry import query, table


@query("q_add_columns", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period FROM orders""")
def add_columns(spark, folder):
    specs = [{"name": "year", "expression": "year(o_orderdate)"}, {"name": "month", "expression": "month(o_orderdate)"},
             {"name": "period", "expression": "year * 100 + month"}]
    return columns.add_columns(table(spark, folder, "orders"), specs).select("o_orderkey", "year", "month", "period")


@query("q_select_rename", "SELECT o_orderkey AS id, o_totalprice AS y, o_orderstatus AS status FROM orders")
def select_rename(spark, folder):
    return columns.select_renamed(table(spark, folder, "orders"), {"o_orderkey": "id", "o_totalprice": "y", "o_orderstatus": "status"})


@query("q_drop_cols", "SELECT p_partkey, p_size, p_retailprice FROM part")
def drop_cols(spark, folder):
    return columns.drop_columns(table(spark, folder, "part"), ["p_name", "p_brand", "p_type"])


@query("q_year", "SELECT event_id, CAST(year(ts) AS INTEGER) AS year FROM events")
def year_part(spark, folder):
    return table(spark, folder, "events").select("event_id", F.year("ts").alias("year"))


@query("q_dropna", """
    SELECT event_id, nullif(event_type, 'error') AS kind, value FROM events WHERE event_type <> 'error'""")
def dropna(spark, folder):
    kind = F.nullif(F.col("event_type"), F.lit("error")).alias("kind")
    return columns.drop_null_rows(table(spark, folder, "events").select("event_id", kind, "value"), ["kind", "value"])


@query("q_conditional_update", """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_acctbal * 0.5 ELSE c_acctbal END AS c_acctbal FROM customer""")
def conditional_update(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return columns.update_where(customer, "c_acctbal", F.col("c_acctbal") < 0, F.col("c_acctbal") * 0.5)


@query("q_history_range", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""")
def history_range(spark, folder):
    return columns.between_dates(table(spark, folder, "orders"), "o_orderdate", "1997-01-01", "1998-01-01").select("o_orderkey", "o_totalprice")


@query("q_group_nonnull_count", """
    SELECT nullif(event_type, 'error') AS category, CAST(count(event_id) AS BIGINT) AS event_id, CAST(count(nullif(user_id, 8)) AS BIGINT) AS user_id,
           CAST(count(ts) AS BIGINT) AS date, CAST(count(year(ts)) AS BIGINT) AS year
    FROM events WHERE nullif(event_type, 'error') IS NOT NULL GROUP BY 1""")
def group_nonnull_count(spark, folder):
    records = table(spark, folder, "events").select(
        F.nullif(F.col("event_type"), F.lit("error")).alias("category"), "event_id",
        F.nullif(F.col("user_id"), F.lit(8)).alias("user_id"), F.col("ts").alias("date"), F.year("ts").alias("year"))
    return grouping.nonnull_counts(records, "category")


@query("q_detect_task", """
    SELECT name, CAST(n AS BIGINT) AS n_labels,
           CASE WHEN n > 10 THEN 'regression' WHEN n > 2 THEN 'multiclass' ELSE 'classification' END AS task
    FROM (SELECT 'l_extendedprice' AS name, count(DISTINCT l_extendedprice) AS n FROM lineitem
          UNION ALL SELECT 'label', count(DISTINCT label) FROM embeddings
          UNION ALL SELECT 'quality', count(DISTINCT quality) FROM labels
          UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag) FROM lineitem)""")
def detect_task(spark, folder):
    found = None
    for source, label in (("lineitem", "l_extendedprice"), ("embeddings", "label"), ("labels", "quality"), ("lineitem", "l_returnflag")):
        one = grouping.detect_task(table(spark, folder, source), label).withColumn("name", F.lit(label))
        found = one if found is None else found.unionByName(one)
    return found


@query("q_sorted_top", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey LIMIT 100""")
def sorted_top(spark, folder):
    return table(spark, folder, "orders").orderBy("o_custkey", "o_orderdate", "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice").limit(100)


@query("q_head", "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 5")
def head(spark, folder):
    return table(spark, folder, "events").orderBy("event_id").select("event_id", "event_type", "value").limit(5)


@query("q_scalar_suite", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
           strftime(o_orderdate + INTERVAL 365 DAY, '%Y-%m-%d') AS next_year, strftime(o_orderdate - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before,
           strftime(o_orderdate, '%Y%m') AS period, 'order_' || o_orderkey || '_' || o_orderstatus || '.csv' AS file_name,
           trim(split_part(o_orderpriority, '-', 2)) AS priority, round(abs(o_totalprice - 100000), 4) AS deviation,
           round(sqrt(o_totalprice), 6) AS root, round(0.4 * o_totalprice + 0.6 * o_custkey, 4) AS weighted,
           o_totalprice > 100000 AND o_orderstatus = 'P' AS both_hold
    FROM orders""")
def scalar_suite(spark, folder):
    date, price = F.col("o_orderdate"), F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        "o_orderkey", F.year(date).alias("y"), F.month(date).alias("m"),
        F.date_format(F.date_add(date, 365), "yyyy-MM-dd").alias("next_year"), F.date_format(F.date_sub(date, 1), "yyyy-MM-dd").alias("day_before"),
        F.date_format(date, "yyyyMM").alias("period"),
        F.format_string("order_%d_%s.csv", "o_orderkey", "o_orderstatus").alias("file_name"),
        F.trim(F.split_part("o_orderpriority", F.lit("-"), F.lit(2))).alias("priority"),
        F.round(F.abs(price - 100000), 4).alias("deviation"), F.round(F.sqrt(price), 6).alias("root"),
        F.round(0.4 * price + 0.6 * F.col("o_custkey"), 4).alias("weighted"),
        ((price > 100000) & (F.col("o_orderstatus") == "P")).alias("both_hold"))
