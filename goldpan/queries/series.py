"""Time-series preparation: daily price and volume per market segment, hourly and raw event series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.operators import series
from goldpan.operators.ordering import number_rows
from goldpan.queries.registry import query, table
from goldpan.session import materialize

# the same daily series in SQL: integer cents, so that sums over windows are exact
DAILY_SQL = """
    daily AS (SELECT c_mktsegment AS series_id, CAST(o_orderdate AS DATE) AS ds,
                     CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, CAST(count(*) AS BIGINT) AS volume
              FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def text(ds: str = "ds"):
    return F.date_format(ds, "yyyy-MM-dd").alias("ds")


def hour_text(ds: str = "ds"):
    """Date and hour, without a detour through the session zone."""
    return F.substring(F.col(ds).cast("string"), 1, 13)


def daily(spark: SparkSession, folder: str) -> DataFrame:
    """(series_id, ds, cents, volume): order totals per market segment and day."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    segments = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("long"))
    return series.to_grain(orders.join(segments, "o_custkey"), F.col("c_mktsegment"), F.col("o_orderdate"), "day",
                           {"cents": cents, "volume": F.count("*")})


def stored_daily(spark: SparkSession, folder: str) -> DataFrame:
    """The daily series, written once for queries that use it on several branches: the raw tables are read once."""
    return materialize(daily(spark, folder))


def _rolling_sql(value: str, n: int) -> str:
    return f"""
    WITH {DAILY_SQL}
    SELECT series_id, strftime(ds, '%Y-%m-%d') AS ds,
           CASE WHEN count(*) OVER w = {n} THEN round(CAST(sum({value}) OVER w AS DOUBLE) / {n}, 4) END AS mean
    FROM daily WINDOW w AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"""


def _rolling(spark, folder, value: str, n: int) -> DataFrame:
    mean = series.rolling_mean(daily(spark, folder), value, n, "mean")
    return mean.select("series_id", text(), F.round("mean", 4).alias("mean"))


@query("q_rolling_mean_100", _rolling_sql("volume", 100))
def rolling_mean_100(spark, folder):
    return _rolling(spark, folder, "volume", 100)


@query("q_rolling_mean_400", _rolling_sql("cents", 400))
def rolling_mean_400(spark, folder):
    return _rolling(spark, folder, "cents", 400)


@query("q_smooth_10", _rolling_sql("cents", 10))
def smooth_10(spark, folder):
    return _rolling(spark, folder, "cents", 10)


@query("q_rolling_mean_raw", """
    SELECT event_id, CASE WHEN count(*) OVER w = 100 THEN round(CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS DOUBLE) / 100, 4) END AS mean
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""")
def rolling_mean_raw(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "ts", F.round(F.col("value") * 100).cast("long").alias("cents"))
    mean = series.rolling_mean_long(events, "cents", 100, "mean", ["event_type"], ["ts", "event_id"])
    return mean.select("event_id", F.round("mean", 4).alias("mean"))


@query("q_row_positions", """
    SELECT event_id, CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS BIGINT) AS rn,
           CAST(count(*) OVER (PARTITION BY event_type) AS BIGINT) AS n FROM events""")
def row_positions(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "ts")
    return number_rows(events, ["event_type"], ["ts", "event_id"], "rn", "n").select("event_id", "rn", "n")


# gaps for the fill queries: keep the value of days whose volume is above 1
_GAPS_SQL = f"WITH {DAILY_SQL}, gaps AS (SELECT series_id, ds, CASE WHEN volume > 1 THEN cents END AS v FROM daily)"
_BFILL = "first(v IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
_FFILL = "last(v IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _gaps(spark, folder) -> DataFrame:
    return daily(spark, folder).select("series_id", "ds", F.when(F.col("volume") > 1, F.col("cents")).alias("v"))


@query("q_bfill", f"{_GAPS_SQL} SELECT series_id, strftime(ds, '%Y-%m-%d') AS ds, {_BFILL.replace('v IGNORE', 'v IGNORE')} AS filled FROM gaps")
def bfill(spark, folder):
    return _gaps(spark, folder).select("series_id", text(), series.backfill("v").alias("filled"))


@query("q_ffill", f"{_GAPS_SQL} SELECT series_id, strftime(ds, '%Y-%m-%d') AS ds, {_FFILL} AS filled FROM gaps")
def ffill(spark, folder):
    return _gaps(spark, folder).select("series_id", text(), series.forwardfill("v").alias("filled"))


@query("q_fill_both", f"{_GAPS_SQL} SELECT series_id, strftime(ds, '%Y-%m-%d') AS ds, coalesce(v, {_BFILL}, {_FFILL}) AS filled FROM gaps")
def fill_both(spark, folder):
    return _gaps(spark, folder).select("series_id", text(), series.fill_both("v").alias("filled"))


@query("q_tail_n", f"""
    WITH {DAILY_SQL} SELECT series_id, strftime(ds, '%Y-%m-%d') AS ds, cents
    FROM daily QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) <= 30""")
def tail_n(spark, folder):
    return series.last_rows(daily(spark, folder), 30).select("series_id", text(), "cents")


@query("q_time_split", f"""
    WITH {DAILY_SQL}
    SELECT series_id, strftime(ds, '%Y-%m-%d') AS ds,
           row_number() OVER (PARTITION BY series_id ORDER BY ds) <= floor(count(*) OVER (PARTITION BY series_id) * 0.8) AS is_train
    FROM daily""")
def time_split(spark, folder):
    return series.time_split(daily(spark, folder)).select("series_id", text(), "is_train")


@query("q_time_split_raw", """
    SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id)
                     <= floor(count(*) OVER (PARTITION BY event_type) * 0.8) AS is_train
    FROM events""")
def time_split_raw(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "ts")
    return series.time_split_long(events, ["event_type"], ["ts", "event_id"]).select("event_id", "is_train")


@query("q_time_axis", """
    SELECT event_id, strftime(TIMESTAMP '2022-01-01 00:00:00' + (event_id * INTERVAL 1 HOUR), '%Y-%m-%d %H:%M:%S') AS ds FROM events""")
def time_axis(spark, folder):
    events = table(spark, folder, "events").select("event_id", (F.col("event_id") + 1).cast("int").alias("at"))
    moments = series.time_axis(events, "2022-01-01 00:00:00", "interval 1 hour", "at")
    return moments.select("event_id", F.col("ds").cast("string").alias("ds"))


@query("q_hist_future_split", f"""
    WITH {DAILY_SQL}, ends AS (SELECT series_id, max(ds) AS last FROM daily WHERE ds < DATE '2000-01-01' GROUP BY 1)
    SELECT series_id, strftime(ds, '%Y-%m-%d') AS ds, ds > last AS is_future FROM daily JOIN ends USING (series_id)""")
def hist_future_split(spark, folder):
    days = stored_daily(spark, folder)
    ends = series.series_end(days.filter(F.col("ds") < F.lit("2000-01-01").cast("date")))
    return series.split_at(days, ends).select("series_id", text(), "is_future")


@query("q_year_window", f"""
    WITH {DAILY_SQL}, ends AS (SELECT series_id, max(ds) AS last FROM daily WHERE ds < DATE '2000-01-01' GROUP BY 1)
    SELECT series_id, strftime(ds, '%Y-%m-%d') AS ds, cents FROM daily JOIN ends USING (series_id)
    WHERE ds BETWEEN last - 365 AND last + 365""")
def year_window(spark, folder):
    days = stored_daily(spark, folder)
    ends = series.series_end(days.filter(F.col("ds") < F.lit("2000-01-01").cast("date")))
    return series.around_last(days, ends).select("series_id", text(), "cents")


_FUTURE_SQL = f"""
    WITH {DAILY_SQL}, ends AS (SELECT series_id, max(ds) AS last FROM daily GROUP BY 1),
    frame AS (SELECT series_id, ds FROM daily
              UNION ALL SELECT series_id, CAST(last + i AS DATE) FROM ends, (SELECT CAST(unnest(range(1, 366)) AS INTEGER) AS i))"""


@query("q_future_frame", f"{_FUTURE_SQL} SELECT series_id, strftime(ds, '%Y-%m-%d') AS ds FROM frame")
def future_frame(spark, folder):
    return series.future_frame(stored_daily(spark, folder), 365, "interval 1 day").select("series_id", text())


@query("q_left_join_future", f"""{_FUTURE_SQL}
    SELECT series_id, strftime(ds, '%Y-%m-%d') AS ds, cents, volume FROM frame LEFT JOIN daily USING (series_id, ds)""")
def left_join_future(spark, folder):
    days = stored_daily(spark, folder)
    joined = series.attach_regressors(series.future_frame(days, 365, "interval 1 day"), days, ["cents", "volume"])
    return joined.select("series_id", text(), "cents", "volume")


HOURLY_SQL = """
    hourly AS (SELECT event_type AS series_id, date_trunc('hour', ts) AS ds, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
               FROM events GROUP BY 1, 2)"""


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    """(series_id, ds, cents): event values per type and hour."""
    cents = F.sum(F.round(F.col("value") * 100).cast("long"))
    return series.to_grain(table(spark, folder, "events"), F.col("event_type"), F.col("ts"), "hour", {"cents": cents})


@query("q_ts_lags", f"""
    WITH {HOURLY_SQL}, d AS (SELECT series_id, ds, cents - lag(cents) OVER (PARTITION BY series_id ORDER BY ds) AS diff FROM hourly)
    SELECT series_id, strftime(ds, '%Y-%m-%d %H') AS ds, diff,
           {', '.join(f'lag(diff, {i}) OVER (PARTITION BY series_id ORDER BY ds) AS lag{i}' for i in range(1, 6))} FROM d""")
def ts_lags(spark, folder):
    hours = hourly(spark, folder)
    differences = series.lags(hours, "cents", 1).select("series_id", "ds", (F.col("cents") - F.col("lag1")).alias("diff"))
    return series.lags(differences, "diff", 5).withColumn("ds", hour_text())


@query("q_ts_seasonal_diff", f"""
    WITH {HOURLY_SQL}, s AS (SELECT series_id, ds, cents - lag(cents, 12) OVER (PARTITION BY series_id ORDER BY ds) AS v FROM hourly)
    SELECT series_id, strftime(ds, '%Y-%m-%d %H') AS ds, v - lag(v) OVER (PARTITION BY series_id ORDER BY ds) AS w FROM s""")
def ts_seasonal_diff(spark, folder):
    differenced = series.seasonal_difference(hourly(spark, folder), "cents", 12, "w")
    return differenced.select("series_id", hour_text().alias("ds"), "w")


def mixed_steps(spark: SparkSession, folder: str) -> DataFrame:
    """(series_id, ds): hourly, daily and monthly series in one table."""
    days = daily(spark, folder).select("series_id", "ds")
    months = days.select(F.concat(F.lit("monthly "), "series_id").alias("series_id"), F.trunc("ds", "month").alias("ds")).distinct()
    month_ends = months.select(F.concat(F.lit("end of "), "series_id").alias("series_id"), F.last_day("ds").alias("ds"))
    at_midnight = days.unionByName(months).unionByName(month_ends).withColumn("ds", F.col("ds").cast("timestamp_ntz"))
    return hourly(spark, folder).select("series_id", "ds").unionByName(at_midnight)


@query("q_future_frame_inferred", f"""
    WITH {DAILY_SQL}, {HOURLY_SQL},
    months AS (SELECT DISTINCT 'monthly ' || series_id AS series_id, date_trunc('month', ds) AS ds FROM daily),
    every AS (SELECT series_id, ds::TIMESTAMP AS ds FROM hourly UNION ALL SELECT series_id, ds::TIMESTAMP FROM daily
              UNION ALL SELECT series_id, ds::TIMESTAMP FROM months UNION ALL SELECT 'end of ' || series_id, last_day(ds::DATE)::TIMESTAMP FROM months),
    pairs AS (SELECT series_id, ds, lag(ds) OVER (PARTITION BY series_id ORDER BY ds) AS before FROM every),
    kinds AS (SELECT *, (last_day(ds::DATE) = ds::DATE AND last_day(before::DATE) = before::DATE) AS ends,
                     date_diff('month', before, ds) AS m FROM pairs WHERE before IS NOT NULL),
    distances AS (SELECT series_id, NULL AS months, NULL AS ends, epoch(ds) - epoch(before) AS seconds FROM kinds
                  UNION ALL SELECT series_id, m, ends, NULL FROM kinds
                  WHERE m > 0 AND ds::TIME = before::TIME AND (ends OR day(ds) = day(before))),
    counted AS (SELECT series_id, months, ends, seconds, count(*) AS n FROM distances GROUP BY ALL),
    steps AS (SELECT series_id, months, ends, seconds FROM counted
              QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY n DESC, months NULLS LAST, seconds, ends) = 1),
    last AS (SELECT series_id, max(ds) AS last FROM every GROUP BY 1),
    ahead AS (SELECT series_id, CASE WHEN months IS NULL THEN last + to_seconds(k * seconds::BIGINT)
                                     WHEN ends THEN last_day((last + to_months((k * months)::INTEGER))::DATE)::TIMESTAMP
                                     ELSE last + to_months((k * months)::INTEGER) END AS ds
              FROM last JOIN steps USING (series_id), (SELECT unnest(range(1, 49)) AS k))
    SELECT series_id, strftime(ds, '%Y-%m-%d %H:%M:%S') AS ds FROM (SELECT * FROM every UNION ALL SELECT * FROM ahead)""")
def future_frame_inferred(spark, folder):
    frame = series.future_frame(materialize(mixed_steps(spark, folder)), 48)
    return frame.select("series_id", F.substring(F.col("ds").cast("string"), 1, 19).alias("ds"))
