"""Time-series operators: grain, rolling means, fills, splits and future frames.

Two families:

* Series at a fixed grain (``to_grain``): one row per series and day or hour, so the length of a series is bounded
  by the calendar span, whatever the number of raw rows behind it.  A window per series is then a bounded group;
  hot sources are reduced by map-side aggregation before the shuffle.
* Raw rows of unbounded length (``*_long``): positions come from ``ordering.number_rows`` and windows run over
  chunks with a halo, so one series spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldpan.operators.ordering import number_rows


def to_grain(df: DataFrame, series: Column, ts: Column, grain: str, values: Mapping[str, Column]) -> DataFrame:
    """Aggregate raw rows to (series_id, ds) at ``day`` or ``hour`` grain."""
    if grain not in ("day", "hour"):
        raise ValueError(f"grain must be day or hour, not {grain!r}")
    if grain == "day":
        ds = F.to_date(ts)
    else:  # stays without time zone, unlike date_trunc
        ds = ts - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(ts), F.extract(F.lit("SECOND"), ts))
    return df.groupBy(series.alias("series_id"), ds.alias("ds")).agg(*[v.alias(n) for n, v in values.items()])


def _order(ds: str, *series: str):
    return Window.partitionBy(*series).orderBy(ds)


def _window_means(df: DataFrame, value: str, n: int, name: str, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Mean over exactly ``n`` non-null rows per group, null while the window is not full.

    Groups are cut into blocks of ``n`` rows.  A window is the tail of one block and the head of the next, and both are running sums
    inside their block.  So the cost of a row does not depend on ``n``, and nothing is subtracted that could cancel.
    """
    whole = Window.partitionBy(*groups)
    block = Window.partitionBy(*groups, "_block")
    upwards = block.orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    downwards = block.orderBy(F.desc("_at")).rowsBetween(Window.unboundedPreceding, 0)
    placed = df.withColumn("_at", F.row_number().over(whole.orderBy(*order)).cast("long") - 1).withColumn("_block", F.floor(F.col("_at") / n))
    summed = placed.withColumns({"_head": F.struct(F.sum(value).over(upwards).alias("s"), F.count(value).over(upwards).alias("n")),
                                 "_tail": F.struct(F.sum(value).over(downwards).alias("s"), F.count(value).over(downwards).alias("n"))})
    # of a row that ends a block the whole window is the head
    before = summed.withColumn("_before", F.when(F.col("_at") % n != n - 1, F.lag("_tail", n - 1).over(whole.orderBy("_at"))))
    known = F.col("_head.n") + F.coalesce("_before.n", F.lit(0))
    total = F.col("_head.s") + F.coalesce("_before.s", F.lit(0))
    return before.withColumn(name, F.when(known == n, total / n)).drop("_at", "_block", "_head", "_tail", "_before")


def rolling_mean(df: DataFrame, value: str, n: int, name: str, series: str = "series_id", ds: str = "ds") -> DataFrame:
    return _window_means(df, value, n, name, [series], [ds])


def rolling_mean_long(
    df: DataFrame, value: str, n: int, name: str, series: Sequence[str], order: Sequence[str], chunk: int = 1_000_000
) -> DataFrame:
    """Rolling mean over raw rows: a series of any length is cut into chunks of rows.

    The last n-1 rows of a chunk are copied in front of the next one, so every window is complete inside its chunk.
    """
    chunk = max(chunk, n - 1)
    numbered = number_rows(df, series, order, "_rn")
    home = F.floor((F.col("_rn") - 1) / chunk).cast("long")
    offset = (F.col("_rn") - 1) % chunk
    spread = numbered.withColumn("_home", home).withColumn(
        "_chunk",
        F.explode(F.when(offset >= chunk - (n - 1), F.array(F.col("_home"), F.col("_home") + 1))
                  .otherwise(F.array(F.col("_home")))),
    )
    means = _window_means(spread, value, n, name, [*series, "_chunk"], ["_rn"])
    return means.filter(F.col("_chunk") == F.col("_home")).drop("_rn", "_home", "_chunk")


def backfill(value: str, series: str = "series_id", ds: str = "ds") -> Column:
    """Next known value at or after the row."""
    # read backwards, so the frame grows row by row; a frame that shrinks would be evaluated anew for every row
    backwards = Window.partitionBy(series).orderBy(F.desc(ds)).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(value, ignorenulls=True).over(backwards)


def forwardfill(value: str, series: str = "series_id", ds: str = "ds") -> Column:
    """Last known value at or before the row."""
    return F.last(value, ignorenulls=True).over(_order(ds, series).rowsBetween(Window.unboundedPreceding, 0))


def fill_both(value: str, series: str = "series_id", ds: str = "ds") -> Column:
    """Backward fill first; what is still empty at the end of the series takes the last known value."""
    return F.coalesce(F.col(value), backfill(value, series, ds), forwardfill(value, series, ds))


def last_rows(df: DataFrame, n: int, series: str = "series_id", ds: str = "ds") -> DataFrame:
    """The last ``n`` rows of every series; map tasks pass on at most ``n`` rows per series."""
    window = Window.partitionBy(series).orderBy(F.desc(ds))
    return df.withColumn("_back", F.row_number().over(window)).filter(F.col("_back") <= n).drop("_back")


def time_split(df: DataFrame, share: float = 0.8, series: str = "series_id", ds: str = "ds") -> DataFrame:
    """Adds ``is_train``: the first int(share * n) rows of every series in time order."""
    ordered = _order(ds, series)
    total = F.count("*").over(Window.partitionBy(series))
    return df.withColumn("is_train", F.row_number().over(ordered) <= F.floor(total * F.lit(share)))


def time_split_long(df: DataFrame, series: Sequence[str], order: Sequence[str], share: float = 0.8) -> DataFrame:
    """``time_split`` for raw rows of unbounded series."""
    numbered = number_rows(df, series, order, "_rn", "_n")
    return numbered.withColumn("is_train", F.col("_rn") <= F.floor(F.col("_n") * F.lit(share))).drop("_rn", "_n")


def number_tests(test: DataFrame, series: str = "series_id", ds: str = "ds") -> DataFrame:
    """Adds ``step``: how many moments after the training part a row lies."""
    return test.withColumn("step", F.row_number().over(_order(ds, series)))


def series_end(df: DataFrame, series: str = "series_id", ds: str = "ds") -> DataFrame:
    return df.groupBy(series).agg(F.max(ds).alias("_last"))


def split_at(df: DataFrame, ends: DataFrame, series: str = "series_id", ds: str = "ds") -> DataFrame:
    """Adds ``is_future``: rows after the last known moment of their series."""
    return df.join(ends, series).withColumn("is_future", F.col(ds) > F.col("_last")).drop("_last")


def around_last(df: DataFrame, ends: DataFrame, days: int = 365, series: str = "series_id", ds: str = "ds") -> DataFrame:
    """Rows within ``days`` before and after the last known moment of their series."""
    return (
        df.join(ends, series)
        .filter(F.col(ds).between(F.date_sub("_last", days), F.date_add("_last", days)))
        .drop("_last")
    )


def inferred_steps(history: DataFrame, series: str = "series_id", ds: str = "ds") -> DataFrame:
    """The most frequent distance between neighbouring moments of every series, as ``months``/``month_end`` or ``gap``.

    Distances are counted in time and, where moments lie on the same day of the month or both at its end, in whole months; months win
    a tie, then the shorter distance.  Series with fewer than two moments have no row.
    """
    moments = history.select(series, F.col(ds).cast("timestamp_ntz").alias("_at")).distinct()
    pairs = moments.withColumn("_before", F.lag("_at").over(Window.partitionBy(series).orderBy("_at"))).where(F.col("_before").isNotNull())
    at, before = F.col("_at"), F.col("_before")
    day, day_before = F.to_date(at), F.to_date(before)
    same_time = (at - day.cast("timestamp_ntz")) == (before - day_before.cast("timestamp_ntz"))
    ends = (day == F.last_day(day)) & (day_before == F.last_day(day_before))
    months = (F.year(at) - F.year(before)) * 12 + F.month(at) - F.month(before)
    whole = same_time & (months > 0) & (ends | (F.dayofmonth(at) == F.dayofmonth(before)))
    nothing = F.lit(None)
    distances = F.array(
        F.struct(nothing.cast("int").alias("months"), nothing.cast("boolean").alias("month_end"), (at - before).alias("gap")),
        F.struct(F.when(whole, months).cast("int").alias("months"), F.when(whole, ends).alias("month_end"),
                 nothing.cast("interval day to second").alias("gap")))
    counted = pairs.select(series, F.explode(distances).alias("d")).where("d.months is not null or d.gap is not null").groupBy(
        series, "d.months", "d.month_end", "d.gap").agg(F.count("*").alias("_n"))
    first = Window.partitionBy(series).orderBy(F.desc("_n"), F.col("months").asc_nulls_last(), "gap", "month_end")
    return counted.withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r", "_n")


def horizon(ends: DataFrame, periods: int, step: str = "interval 1 day", series: str = "series_id", ds: str = "ds") -> DataFrame:
    """``periods`` future moments after the end of every series."""
    one, last = F.expr(step), F.col("_last").cast("timestamp_ntz")
    moments = F.sequence(last + one, last + one * periods, one)
    return ends.select(series, F.explode(moments).alias(ds))


def inferred_horizon(ends: DataFrame, steps: DataFrame, periods: int, alone: str = "interval 1 day", series: str = "series_id", ds: str = "ds") -> DataFrame:
    """``periods`` future moments at the inferred step of every series; one without a step goes on by ``alone``.

    Months are counted from the last known moment, so a series on the 31st comes back to it after a shorter month.
    """
    last, k = F.col("_last").cast("timestamp_ntz"), F.col("_k")
    moved = last + F.make_ym_interval(F.lit(0), F.col("months") * k)
    to_end = F.make_dt_interval(F.datediff(F.last_day(F.to_date(moved)), F.to_date(moved)))
    monthly = F.when(F.col("month_end"), moved + to_end).otherwise(moved)
    regular = last + F.coalesce(F.col("gap"), F.expr(alone).cast("interval day to second")) * k
    ahead = ends.join(steps, series, "left").withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    return ahead.select(series, F.when(F.col("months").isNotNull(), monthly).otherwise(regular).alias(ds))


def future_frame(history: DataFrame, periods: int, step: str | None = None, series: str = "series_id", ds: str = "ds") -> DataFrame:
    """History moments followed by the horizon, at ``step`` or, without one, at the step of each series itself."""
    known = history.select(series, ds)
    kind = known.schema[ds].dataType.simpleString()
    ends = series_end(history, series, ds)
    ahead = horizon(ends, periods, step, series, ds) if step else inferred_horizon(ends, inferred_steps(history, series, ds), periods, series=series, ds=ds)
    return known.unionByName(ahead.withColumn(ds, F.col(ds).cast(kind)))


def attach_regressors(frame: DataFrame, known: DataFrame, columns: Sequence[str], series: str = "series_id", ds: str = "ds") -> DataFrame:
    """Left join of the known regressor values by series and moment."""
    return frame.join(known.select(series, ds, *columns), [series, ds], "left")


def time_axis(df: DataFrame, start: str, step: str, position: str, name: str = "ds") -> DataFrame:
    """A synthetic moment for existing rows: ``start`` plus (position - 1) steps."""
    origin = F.lit(start).cast("timestamp_ntz")
    return df.withColumn(name, origin + F.expr(step) * (F.col(position) - 1))


def lags(df: DataFrame, value: str, n: int, series: str = "series_id", ds: str = "ds") -> DataFrame:
    """Columns lag1..lagn of ``value``."""
    ordered = _order(ds, series)
    return df.withColumns({f"lag{i}": F.lag(value, i).over(ordered) for i in range(1, n + 1)})


def seasonal_difference(df: DataFrame, value: str, period: int, name: str, series: str = "series_id", ds: str = "ds") -> DataFrame:
    """First difference of the difference to the value one season earlier."""
    ordered = _order(ds, series)
    season = df.withColumn("_s", F.col(value) - F.lag(value, period).over(ordered))
    return season.withColumn(name, F.col("_s") - F.lag("_s", 1).over(ordered)).drop("_s")
