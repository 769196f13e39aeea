"""Forecasters for many series at once.

Input: rows (series_id, ds, y) at a fixed grain, so the length of a series is bounded by the calendar span.
Output: rows (series_id, ds, yhat) for the asked moments.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.operators.series import (
    around_last,
    attach_regressors,
    backfill,
    fill_both,
    future_frame,
    lags,
    rolling_mean,
    series_end,
    split_at,
)
from goldpan.session import materialize

# ---------------------------------------------------------------- autoregression on differences


def autoregression(history: DataFrame, horizon: int, order: int = 5) -> DataFrame:
    """Least squares on ``order`` lagged first differences, continued recursively.

    The normal equations of all series come out of one aggregation; what reaches Python is one row per series.
    """
    differenced = lags(history, "y", 1).select("series_id", "ds", "y", (F.col("y") - F.col("lag1")).alias("d"))
    rows = lags(differenced, "d", order)
    names = [f"lag{i}" for i in range(1, order + 1)]
    full = F.col(names[-1]).isNotNull()
    cross = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    last = F.struct("y", "d", *names[:-1])
    sums = rows.groupBy("series_id").agg(
        F.array(*[F.coalesce(F.sum(F.when(full, F.col(a) * F.col(b))), F.lit(0.0)) for a, b in cross]).alias("xx"),
        F.array(*[F.coalesce(F.sum(F.when(full, F.col(a) * F.col("d"))), F.lit(0.0)) for a in names]).alias("xy"),
        F.max_by(last, "ds").alias("last"))

    @F.pandas_udf("array<double>")
    def continue_series(xx: pd.Series, xy: pd.Series, level: pd.Series, recent: pd.Series) -> pd.Series:
        out = []
        for g, b, y, d in zip(xx, xy, level, recent):
            gram = np.zeros((order, order))
            gram[np.triu_indices(order)] = g
            gram = gram + np.triu(gram, 1).T
            phi = np.linalg.lstsq(gram, np.asarray(b, dtype=float), rcond=1e-10)[0]
            out.append(_roll_forward(phi, np.nan_to_num(np.asarray(d, dtype=float)), y, horizon))
        return pd.Series(out)

    steps = continue_series("xx", "xy", "last.y", F.array("last.d", *[f"last.{c}" for c in names[:-1]]))
    return sums.select("series_id", F.posexplode(steps).alias("step", "yhat")).withColumn("step", F.col("step") + 1)


def _roll_forward(phi: np.ndarray, recent: np.ndarray, level: float, horizon: int) -> list[float]:
    state, values = list(recent), []
    for _ in range(horizon):
        d = float(phi @ np.asarray(state))
        level = level + d
        values.append(level)
        state = [d, *state[:-1]]
    return values


# ---------------------------------------------------------------- seasonal model


def seasonal(history: DataFrame, horizon: int, period: int = 12) -> DataFrame:
    """(1,1,1)(1,1,1,period) by two-stage least squares: residuals of a long autoregression stand in for the shocks.

    One group per series at a fixed grain.  ``status`` says which model a series got: one with too few moments for the seasonal
    equations is continued by ``autoregression``.
    """
    kind = history.schema["series_id"].dataType.simpleString()

    def forecast(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values("ds")["y"].to_numpy(dtype=float)
        return pd.DataFrame({"series_id": pdf["series_id"].iloc[0], "step": np.arange(1, horizon + 1, dtype="int32"),
                             "yhat": _seasonal_values(y, horizon, period)})

    rows = history.select("series_id", "ds", "y")
    enough = rows.groupBy("series_id").agg(F.count("*").alias("_n")).where(F.col("_n") >= least_moments(period)).select("series_id")
    of_long = rows.join(enough, "series_id", "left_semi").groupBy("series_id").applyInPandas(forecast, f"series_id {kind}, step int, yhat double")
    of_short = autoregression(rows.join(enough, "series_id", "left_anti"), horizon)
    return of_long.withColumn("status", F.lit("seasonal")).unionByName(
        of_short.select("series_id", "step", "yhat", F.lit("autoregression").alias("status")))


def least_moments(period: int) -> int:
    """Moments that the seasonal equations need: three periods, and more equations than unknowns."""
    return max(3 * period + 3, 2 * period + 10)


def _lagged(values: np.ndarray, at: Sequence[int], start: int) -> np.ndarray:
    return np.column_stack([values[start - k:len(values) - k] for k in at])


def _seasonal_values(y: np.ndarray, horizon: int, period: int) -> np.ndarray:
    w = np.diff(y[period:] - y[:-period])
    long = min(period + 1, len(w) // 4)
    x = _lagged(w, range(1, long + 1), long)
    phi = np.linalg.lstsq(x, w[long:], rcond=None)[0]
    shocks = np.concatenate([np.zeros(long), w[long:] - x @ phi])
    at = [1, period, period + 1]
    start = max(at)
    both = np.hstack([_lagged(w, at, start), _lagged(shocks, at, start)])
    ridge = 1e-6 * np.trace(both.T @ both) / both.shape[1] * np.eye(both.shape[1])
    beta = np.linalg.solve(both.T @ both + ridge, both.T @ w[start:])
    w_all, e_all, levels = list(w), list(shocks), list(y)
    for _ in range(horizon):
        nxt = float(np.dot(beta, [w_all[-k] for k in at] + [e_all[-k] for k in at]))
        bound = 3 * float(np.abs(w).max())
        nxt = min(max(nxt, -bound), bound)  # an unstable root must not run away
        w_all.append(nxt)
        e_all.append(0.0)
        levels.append(nxt + levels[-1] + levels[-period] - levels[-period - 1])
    return np.array(levels[-horizon:])


# ---------------------------------------------------------------- trend and seasonality

SERIES_IN_TASK = 256  # series whose products a task holds before it hands them on

@dataclass(frozen=True)
class Decomposition:
    """Piecewise-linear trend plus Fourier seasons plus optional regressors, fitted by ridge per series."""

    changepoints: int = 25
    changepoint_scale: float = 0.05
    season_scale: float = 10.0
    yearly: int = 10
    weekly: int = 3
    daily: int = 0
    regressors: tuple[str, ...] = field(default_factory=tuple)

    def facts(self, history: DataFrame) -> DataFrame:
        """Per series: start, span, scale of y, mean and deviation of the regressors."""
        seconds = _seconds("ds")
        known = [e for r in self.regressors for e in (F.avg(r).alias(f"_m_{r}"), F.stddev_pop(r).alias(f"_s_{r}"))]
        return history.groupBy("series_id").agg(
            F.min(seconds).alias("_start"), (F.max(seconds) - F.min(seconds)).alias("_span"), F.max(F.abs("y")).alias("_scale"), *known)

    def columns(self) -> list[tuple[str, Column, float]]:
        """Name, expression and prior scale of every design column of a row with the facts of its series."""
        seconds = _seconds("ds")
        t = (seconds - F.col("_start")) / F.when(F.col("_span") > 0, F.col("_span")).otherwise(1.0)
        out: list[tuple[str, Column, float]] = [("one", F.lit(1.0), 5.0), ("t", t, 5.0)]
        for i in range(1, self.changepoints + 1):
            at = 0.8 * i / (self.changepoints + 1)
            out.append((f"hinge{i}", F.greatest(t - F.lit(at), F.lit(0.0)), self.changepoint_scale))
        # a season needs two full periods of history
        for name, days, terms in (("year", 365.25, self.yearly), ("week", 7.0, self.weekly), ("day", 1.0, self.daily)):
            for k in range(1, terms + 1):
                angle = seconds * F.lit(2 * np.pi * k / (86400.0 * days))
                for kind, value in (("sin", F.sin(angle)), ("cos", F.cos(angle))):
                    seen = F.col("_span") >= 2 * days * 86400
                    out.append((f"{name}_{kind}{k}", F.when(seen, value).otherwise(0.0), self.season_scale))
        for r in self.regressors:
            scaled = F.when(F.col(f"_s_{r}") > 0, (F.col(r) - F.col(f"_m_{r}")) / F.col(f"_s_{r}")).otherwise(0.0)
            out.append((r, F.coalesce(scaled, F.lit(0.0)), self.season_scale))
        return out

    def design(self, frame: DataFrame, facts: DataFrame) -> DataFrame:
        """Adds the design row as array ``x``."""
        return frame.join(facts, "series_id").withColumn("x", F.array(*[c.cast("double") for _, c, _ in self.columns()]))

    def fit(self, history: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Facts and coefficients, one row per series each."""
        facts = self.facts(history)
        penalties = np.array([1.0 / scale**2 for _, _, scale in self.columns()])
        d = len(penalties)
        upper = np.triu_indices(d)
        kind = history.schema["series_id"].dataType.simpleString()

        def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """The products of the design rows of every series, one row per series and task instead of one per moment."""
            held: dict = {}

            def handed() -> pd.DataFrame:
                out = pd.DataFrame([(name, g[upper].tolist(), xy.tolist(), yy, n) for name, (g, xy, yy, n) in held.items()],
                                   columns=["series_id", "gram", "xy", "yy", "n"])
                held.clear()
                return out

            for batch in batches:
                for name, rows in batch.groupby("series_id", sort=False, dropna=False):
                    x, y = np.stack(rows["x"].to_numpy()), rows["y"].to_numpy(dtype=float)
                    g, xy, yy, n = held.get(name, (0.0, 0.0, 0.0, 0))
                    held[name] = g + x.T @ x, xy + x.T @ y, yy + float(y @ y), n + len(y)
                if len(held) >= SERIES_IN_TASK:
                    yield handed()
            if held:
                yield handed()

        def solve(pdf: pd.DataFrame) -> pd.DataFrame:
            gram = np.zeros((d, d))
            gram[upper] = np.sum(np.stack(pdf["gram"].to_numpy()), axis=0)
            gram = gram + np.triu(gram, 1).T
            xy, yy, n = np.sum(np.stack(pdf["xy"].to_numpy()), axis=0), float(pdf["yy"].sum()), int(pdf["n"].sum())
            noise = 1e-2
            for _ in range(3):  # noise level and ridge weights settle together
                beta = np.linalg.solve(gram + np.diag(noise * penalties) + 1e-9 * np.eye(d), xy)
                noise = max((yy - 2 * float(beta @ xy) + float(beta @ gram @ beta)) / n, 1e-8)
            return pd.DataFrame({"series_id": [pdf["series_id"].iloc[0]], "beta": [beta.tolist()]})

        rows = self.design(history.filter(F.col("y").isNotNull()), facts).select("series_id", "x", (F.col("y") / scale_of("_scale")).alias("y"))
        parts = rows.mapInPandas(summed, f"series_id {kind}, gram array<double>, xy array<double>, yy double, n long")
        betas = parts.groupBy("series_id").applyInPandas(solve, f"series_id {kind}, beta array<double>")
        scaled = betas.join(facts.select("series_id", scale_of("_scale").alias("_by")), "series_id")
        return facts, materialize(scaled.select("series_id", F.transform("beta", lambda b: b * F.col("_by")).alias("beta")))

    def predict(self, fitted: tuple[DataFrame, DataFrame], frame: DataFrame) -> DataFrame:
        """Adds ``yhat`` to the rows of ``frame``."""
        facts, betas = fitted
        products = F.zip_with("x", "beta", lambda a, b: a * b)
        total = F.aggregate(products, F.lit(0.0), lambda a, b: a + b)
        return self.design(frame, facts).join(betas, "series_id").withColumn("yhat", total).select(*frame.columns, "yhat")


def scale_of(column: str) -> Column:
    """A largest absolute value to divide by; 1 for a series of zeros."""
    return F.when(F.col(column) > 0, F.col(column)).otherwise(1.0)


def _seconds(ds: str) -> Column:
    """Seconds since 1970 of a date or timestamp without time zone, as a double; the session zone plays no part."""
    moment = F.col(ds).cast("timestamp_ntz")
    days = F.datediff(F.to_date(moment), F.lit("1970-01-01").cast("date"))
    return days * F.lit(86400.0) + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


# ---------------------------------------------------------------- flow


# fixed values: window lengths and horizon of the price forecast
SMA_DAYS, VOLUME_DAYS, SMOOTH_DAYS, HORIZON_DAYS = 400, 100, 10, 365


def prepare_regressors(daily: DataFrame, sma: int = SMA_DAYS, volume: int = VOLUME_DAYS) -> DataFrame:
    """Rolling means of value and volume, then backward fill of every column of the series."""
    means = rolling_mean(rolling_mean(daily, "volume", volume, "volume_avg"), "y", sma, "sma")
    return means.withColumns({c: backfill(c) for c in ("y", "volume", "volume_avg", "sma")})


def forecast_frame(prepared: DataFrame, periods: int = HORIZON_DAYS, step: str = "interval 1 day") -> DataFrame:
    """History and horizon with filled regressors."""
    joined = attach_regressors(future_frame(prepared, periods, step), prepared, ["sma", "volume_avg"])
    return joined.withColumns({c: fill_both(c) for c in ("sma", "volume_avg")})


def forecast_prices(daily: DataFrame, periods: int = HORIZON_DAYS, smooth: int = SMOOTH_DAYS) -> DataFrame:
    """(series_id, ds, y, yhat, yhat_smooth, is_future): the whole flow from daily values to a smoothed forecast."""
    prepared = materialize(prepare_regressors(daily))
    model = Decomposition(regressors=("sma", "volume_avg"))
    predicted = model.predict(model.fit(prepared), forecast_frame(prepared, periods))
    smoothed = rolling_mean(predicted, "yhat", smooth, "yhat_smooth")
    ends = series_end(prepared)
    known = prepared.select("series_id", "ds", "y")
    return split_at(smoothed, ends).join(known, ["series_id", "ds"], "left")


def plot_series(forecast: DataFrame, days: int = HORIZON_DAYS) -> DataFrame:
    """Long form (series_id, ds, name, value): actual, past prediction, smoothed future, around the last known day."""
    ends = series_end(forecast.filter(~F.col("is_future")))
    near = around_last(forecast, ends, days)
    entries = F.array(
        F.struct(F.lit("actual").alias("name"), F.col("y").alias("value"), (~F.col("is_future")).alias("use")),
        F.struct(F.lit("predicted_past").alias("name"), F.col("yhat").alias("value"), (~F.col("is_future")).alias("use")),
        F.struct(F.lit("predicted_future").alias("name"), F.col("yhat_smooth").alias("value"), F.col("is_future").alias("use")))
    return near.select("series_id", "ds", F.explode(entries).alias("e")).filter("e.use").select(
        "series_id", "ds", "e.name", "e.value")
