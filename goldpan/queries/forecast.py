"""Forecast inputs, forecasts per series and their evaluation."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.evaluation import harness
from goldpan.models import forecast
from goldpan.operators import series
from goldpan.queries.registry import query
from goldpan.queries.series import DAILY_SQL, daily, hourly, text
from goldpan.session import materialize


def prices(spark: SparkSession, folder: str) -> DataFrame:
    return daily(spark, folder).select("series_id", "ds", F.col("cents").alias("y"), "volume")


_PREPARED = f"""
    {DAILY_SQL}, means AS (
        SELECT series_id, ds, cents AS y, volume,
               CASE WHEN count(*) OVER v = 100 THEN CAST(sum(volume) OVER v AS DOUBLE) / 100 END AS va,
               CASE WHEN count(*) OVER s = 400 THEN CAST(sum(cents) OVER s AS DOUBLE) / 400 END AS sm
        FROM daily WINDOW v AS (PARTITION BY series_id ORDER BY ds ROWS 99 PRECEDING), s AS (PARTITION BY series_id ORDER BY ds ROWS 399 PRECEDING)),
    prepared AS (SELECT series_id, ds, y, volume, first(va IGNORE NULLS) OVER w AS volume_avg, first(sm IGNORE NULLS) OVER w AS sma
                 FROM means WINDOW w AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query("q_forecast_inputs", f"""
    WITH {_PREPARED} SELECT series_id, strftime(ds, '%Y-%m-%d') AS ds, y, volume, round(volume_avg, 4) AS volume_avg, round(sma, 4) AS sma FROM prepared""")
def forecast_inputs(spark, folder):
    prepared = forecast.prepare_regressors(prices(spark, folder))
    return prepared.select("series_id", text(), "y", "volume", F.round("volume_avg", 4).alias("volume_avg"), F.round("sma", 4).alias("sma"))


@query("q_forecast_frame", f"""
    WITH {_PREPARED}, ends AS (SELECT series_id, max(ds) AS last FROM daily GROUP BY 1),
    frame AS (SELECT series_id, ds FROM prepared UNION ALL
              SELECT series_id, CAST(last + i AS DATE) FROM ends, (SELECT CAST(unnest(range(1, 366)) AS INTEGER) AS i)),
    joined AS (SELECT series_id, ds, volume_avg, sma FROM frame LEFT JOIN prepared USING (series_id, ds))
    SELECT series_id, strftime(ds, '%Y-%m-%d') AS ds,
           round(coalesce(first(volume_avg IGNORE NULLS) OVER f, last(volume_avg IGNORE NULLS) OVER b), 4) AS volume_avg,
           round(coalesce(first(sma IGNORE NULLS) OVER f, last(sma IGNORE NULLS) OVER b), 4) AS sma
    FROM joined WINDOW f AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
                       b AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def forecast_frame(spark, folder):
    frame = forecast.forecast_frame(materialize(forecast.prepare_regressors(prices(spark, folder))))
    return frame.select("series_id", text(), F.round("volume_avg", 4).alias("volume_avg"), F.round("sma", 4).alias("sma"))


_DESIGN = forecast.Decomposition(changepoints=3, yearly=2, weekly=1)


def _design_sql() -> str:
    out = ["round(t, 6) AS t"] + [f"round(greatest(t - {0.8 * i / 4}, 0), 6) AS hinge{i}" for i in range(1, 4)]
    for name, days, terms in (("year", 365.25, 2), ("week", 7.0, 1)):
        for k in range(1, terms + 1):
            angle = f"sec * {2 * math.pi * k / (86400.0 * days)!r}::DOUBLE"
            out += [f"round(CASE WHEN span >= {2 * days * 86400} THEN {f}({angle}) ELSE 0 END, 6) + 0.0 AS {name}_{f}{k}" for f in ("sin", "cos")]
    return f"""
    WITH {DAILY_SQL}, s AS (SELECT series_id, ds, epoch(ds)::DOUBLE AS sec FROM daily),
    f AS (SELECT series_id, min(sec) AS start, max(sec) - min(sec) AS span FROM s GROUP BY 1),
    d AS (SELECT series_id, ds, sec, span, (sec - start) / CASE WHEN span > 0 THEN span ELSE 1 END AS t FROM s JOIN f USING (series_id))
    SELECT series_id, strftime(ds, '%Y-%m-%d') AS ds, {', '.join(out)} FROM d"""


@query("q_ts_design", _design_sql())
def ts_design(spark, folder):
    history = materialize(prices(spark, folder))
    rows = history.join(_DESIGN.facts(history), "series_id")
    return rows.select("series_id", text(), *[(F.round(c, 6) + 0.0).alias(n) for n, c, _ in _DESIGN.columns() if n != "one"])


def hours(spark: SparkSession, folder: str) -> DataFrame:
    return hourly(spark, folder).select("series_id", "ds", (F.col("cents") / 100).alias("y"))


@query("q_ts_ar")
def ts_ar(spark, folder):
    return forecast.autoregression(hours(spark, folder), 24)


@query("q_ts_seasonal")
def ts_seasonal(spark, folder):
    return forecast.seasonal(hours(spark, folder), 24)


@query("q_ts_decomp")
def ts_decomp(spark, folder):
    history = materialize(hours(spark, folder))
    model = forecast.Decomposition(daily=4)
    frame = series.future_frame(history, 24, "interval 1 hour")
    return model.predict(model.fit(history), frame).withColumn("ds", F.date_format("ds", "yyyy-MM-dd HH:mm"))


@query("q_ts_decomp_regressors")
def ts_decomp_regressors(spark, folder):
    prepared = materialize(forecast.prepare_regressors(prices(spark, folder)))
    model = forecast.Decomposition(regressors=("sma", "volume_avg"))
    return model.predict(model.fit(prepared), prepared.select("series_id", "ds", "sma", "volume_avg")).select("series_id", text(), "yhat")


@query("q_forecast_future")
def forecast_future(spark, folder):
    out = forecast.forecast_prices(prices(spark, folder))
    return out.filter("is_future").select("series_id", text(), "yhat", "yhat_smooth")


@query("q_forecast_series")
def forecast_series(spark, folder):
    return forecast.plot_series(forecast.forecast_prices(prices(spark, folder))).select("series_id", text(), "name", "value")


@query("q_eval_time_series")
def eval_time_series(spark, folder):
    board, _ = harness.evaluate_time_series(hours(spark, folder))
    return board
