"""Trend, smoothing and health signals of weekly or monthly series.

Inputs are aggregated series: one row per series and period, so the calendar
bounds every group and window here, whatever the size of the raw data.
``series`` lists the columns that tell series apart (may be empty for one).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.weeks import calendar_parts, date_to_week
from tidemark.operators.relational import last_rows

SLOPE_FLAT = 0.01
HEALTH_FLAT = 0.1
DIRECTION_FLAT = 0.05
MEAN_FLAT = 0.001
MOMENTUM_FLAT = 0.05
MAX_REACH = 5


def indexed(df: DataFrame, series: list[str], order: str) -> DataFrame:
    """Add ``i`` (0-based position) and ``n`` (length) within each series."""
    part = W.partitionBy(*series)
    return df.withColumns(
        {"i": F.row_number().over(part.orderBy(order)) - 1, "n": F.count(F.lit(1)).over(part)}
    )


def slope_label(slope: Column, flat: float = SLOPE_FLAT) -> Column:
    return F.when(slope < -flat, "declining").when(slope > flat, "growing").when(slope.isNotNull(), "stable")


def linear_trend(df: DataFrame, series: list[str], order: str, value: str) -> DataFrame:
    """Least-squares line over the position, with direction labels."""
    points = indexed(df.dropna(subset=[value]), series, order)
    y, x = F.col(value).cast("double"), F.col("i").cast("double")
    fit = points.groupBy(*series).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
    )
    return fit.withColumns(
        {
            "direction": F.when(F.col("slope") >= 0, "positive").when(F.col("slope") < 0, "alarm"),
            "label": F.coalesce(slope_label(F.col("slope")), F.lit("insufficient data")),
        }
    )


def trend_line(df: DataFrame, series: list[str], order: str, value: str, level: str | None = None) -> DataFrame:
    """Fitted line per point, floored at 0; with ``level`` also scaled to that column's mean."""
    points = indexed(df.dropna(subset=[value]), series, order)
    y, x = F.col(value).cast("double"), F.col("i").cast("double")
    part = W.partitionBy(*series)
    slope, intercept = F.regr_slope(y, x).over(part), F.regr_intercept(y, x).over(part)
    fitted = F.greatest(intercept + slope * x, F.lit(0.0))
    columns = [*[F.col(s) for s in series], F.col(order), F.col(value), fitted.alias("fitted")]
    if level is not None:
        mean_y = F.avg(y).over(part)
        factor = F.when(mean_y > 0, F.avg(level).over(part) / mean_y).otherwise(1.0)
        columns.append((fitted * factor).alias("fitted_scaled"))
    return points.select(*columns)


# --- LOWESS ---------------------------------------------------------------------------


def lowess_fit(x: np.ndarray, y: np.ndarray, frac: float = 0.3, iters: int = 3) -> np.ndarray:
    """Locally weighted line through sorted points: tricube weights over the
    nearest ``frac`` of the points, then bisquare reweighting by residual."""
    n = len(x)
    k = int(frac * n + 1e-10)
    if n < 3 or k < 2:
        return y.astype(float)
    start = np.zeros(n, dtype=int)
    left = 0
    for i in range(n):
        while left + k < n and x[i] > (x[left] + x[left + k]) / 2:
            left += 1
        start[i] = left
    near = start[:, None] + np.arange(k)[None, :]
    xs, ys = x[near], y[near]
    radius = np.maximum(x - x[start], x[start + k - 1] - x)
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.abs(xs - x[:, None]) / radius[:, None]
    tricube = np.where(d <= 0.001, 1.0, np.where(d < 0.999, (1 - d**3) ** 3, 0.0))
    robust = np.ones(n)
    fit = y.astype(float)
    for _ in range(iters + 1):
        w = tricube * robust[near]
        total = w.sum(axis=1)
        usable = (radius > 0) & (total > 0)
        w = w / np.where(total > 0, total, 1.0)[:, None]
        centre = (w * xs).sum(axis=1)
        spread = np.maximum((w * (xs - centre[:, None]) ** 2).sum(axis=1), 1e-12)
        lever = w * (1 + (x - centre)[:, None] * (xs - centre[:, None]) / spread[:, None])
        fit = np.where(usable, (lever * ys).sum(axis=1), y)
        residual = np.abs(y - fit)
        middle = np.median(residual)
        if 0 < middle <= 1e-12 * np.abs(y).max():
            break  # the fit is exact; what is left is rounding, which must not set weights
        r = np.where(residual > 0, 1.0, 0.0) if middle == 0 else residual / (6 * middle)
        robust = np.where(r <= 0.001, 1.0, np.where(r < 0.999, (1 - r**2) ** 2, 0.0))
    return fit


def lowess(
    df: DataFrame, series: list[str], x: str, y: str, frac: float = 0.3, iters: int = 3, out: str = "smoothed"
) -> DataFrame:
    """Smoothed value per point.  Spark groups the series; each is one short array."""
    rows = df.select(*series, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna(subset=["x", "y"])
    keys = [df.schema[s] for s in series]
    schema = T.StructType([*keys, T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType()), T.StructField(out, T.DoubleType())])

    def smooth(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("x", kind="stable")
        return pdf.assign(**{out: lowess_fit(pdf["x"].to_numpy(), pdf["y"].to_numpy(), frac, iters)})

    if not series:
        return rows.withColumn("_g", F.lit(1)).groupBy("_g").applyInPandas(lambda p: smooth(p[["x", "y"]]), schema)
    return rows.groupBy(*series).applyInPandas(smooth, schema)


# --- turning points and health ------------------------------------------------------------


def smoothed_derivative(df: DataFrame, series: list[str], x: str, y: str) -> DataFrame:
    """Slope from the point before, and its 3-point mean; end values stand in for missing neighbours."""
    points = indexed(df.dropna(subset=[x, y]), series, x)
    w = W.partitionBy(*series).orderBy(x)
    rise = (F.col(y) - F.lag(y).over(w)) / (F.col(x) - F.lag(x).over(w)).cast("double")
    sloped = points.withColumn("_d", rise)
    before, after = F.lag("_d").over(w), F.lead("_d").over(w)
    mean3 = (F.coalesce(before, F.col("_d")) + F.col("_d") + F.coalesce(after, F.col("_d"))) / 3
    return sloped.withColumns({"derivative": F.col("_d"), "smoothed_slope": mean3}).drop("_d")


def inflections(df: DataFrame, series: list[str], x: str, y: str) -> DataFrame:
    """Points at which growth turns to decline or back; series under five points have none."""
    sloped = smoothed_derivative(df, series, x, y).where(F.col("n") >= 5)
    w = W.partitionBy(*series).orderBy(x)
    rising = F.col("smoothed_slope") > 0
    was = F.lag(rising).over(w)
    change = F.when(was & ~rising, "growth_to_decline").when(~was & rising, "decline_to_growth")
    return sloped.withColumn("change", change).where(F.col("change").isNotNull()).select(*series, x, y, "i", "change")


def _relative(slope: Column, x_range: Column, y_range: Column) -> Column:
    return F.when(y_range == 0, F.lit(0.0)).otherwise(slope * x_range / y_range)


def trend_health(df: DataFrame, series: list[str], x: str, y: str) -> DataFrame:
    """decreasing, mixed, increasing or stable, from the overall and the recent slope.

    Slopes are scaled by the ranges of both axes.  Recent means the points from
    position ``floor(0.7 n)`` on.
    """
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    points = indexed(df.dropna(subset=[x, y]), series, x)
    recent = F.col("i") >= F.floor(F.col("n") * 0.7)
    rx, ry = F.when(recent, xd), F.when(recent, yd)
    stats = points.groupBy(*series).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.regr_slope(yd, xd).alias("_s"),
        (F.max(xd) - F.min(xd)).alias("_xr"),
        (F.max(yd) - F.min(yd)).alias("_yr"),
        F.regr_slope(ry, rx).alias("_rs"),
        (F.max(rx) - F.min(rx)).alias("_rxr"),
        (F.max(ry) - F.min(ry)).alias("_ryr"),
        F.count(rx).alias("_rn"),
    )
    turns = inflections(df, series, x, y).where(F.col("change") == "growth_to_decline")
    turns = turns.groupBy(*series).agg(F.count(F.lit(1)).alias("growth_to_decline"))
    if series:
        stats = stats.join(turns, series, "left")
    else:
        stats = stats.withColumn("growth_to_decline", turns.select("growth_to_decline").scalar())
    down = F.coalesce("growth_to_decline", F.lit(0))
    overall = _relative(F.col("_s"), F.col("_xr"), F.col("_yr"))
    late = F.when(F.col("_rn") >= 2, _relative(F.col("_rs"), F.col("_rxr"), F.col("_ryr"))).otherwise(overall)
    scored = stats.withColumns({"relative_slope": overall, "recent_slope": late, "growth_to_decline": down})
    o, r, d = F.col("relative_slope"), F.col("recent_slope"), F.col("growth_to_decline")
    status = (
        F.when((F.col("n_points") < 2) | (F.col("_yr") == 0), "stable")
        .when((r < -HEALTH_FLAT) | ((d > 0) & (r <= 0)), "decreasing")
        .when((o > HEALTH_FLAT) & (r >= 0), F.when(d > 0, "mixed").otherwise("increasing"))
        .otherwise("stable")
    )
    return scored.withColumn("status", status).select(
        *series, "n_points", "relative_slope", "recent_slope", "growth_to_decline", "status"
    )


def recent_direction(df: DataFrame, series: list[str], x: str, y: str) -> DataFrame:
    """Direction of the last fifth (at least five points), slope scaled by the ranges of both axes."""
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    points = indexed(df.dropna(subset=[x, y]), series, x)
    late = F.col("i") >= F.col("n") - F.greatest(F.lit(5), F.floor(F.col("n") / 5))

    def span(c: Column) -> Column:
        width = F.max(c) - F.min(c)
        return F.when(width > 0, width).otherwise(1.0)

    fit = points.groupBy(*series).agg(
        F.count(F.lit(1)).alias("n_points"),
        (F.regr_slope(F.when(late, yd), F.when(late, xd)) * span(xd) / span(yd)).alias("relative_slope"),
    )
    s = F.col("relative_slope")
    label = F.when(F.col("n_points") < 5, "stable").when(s > DIRECTION_FLAT, "increasing").when(s < -DIRECTION_FLAT, "decreasing")
    return fit.withColumn("direction", label.otherwise("stable"))


def _recent_points(df: DataFrame, series: list[str], x: str, y: str, share: float, min_rows: int) -> DataFrame:
    """The last ``max(min_rows, floor(share * n))`` points with ``j``, their position, and ``m``, their number."""
    points = indexed(df.dropna(subset=[x, y]), series, x)
    want = F.greatest(F.lit(min_rows), F.floor(F.col("n") * F.lit(share)).cast("int"))
    m = F.least(want, F.col("n"))
    return points.withColumn("m", m).withColumn("j", F.col("i") - (F.col("n") - F.col("m"))).where(F.col("j") >= 0)


def _slope_over_mean(y: Column) -> Column:
    slope, mean = F.regr_slope(y, F.col("j").cast("double")), F.avg(y)
    return F.when(mean > 0, slope / mean).otherwise(0.0)


def recent_alarm(
    df: DataFrame, series: list[str], x: str, y: str, share: float = 0.3, min_rows: int = 3
) -> DataFrame:
    """Alarm from the slope of the recent points relative to their mean, and from
    the mean of their second half against the first (from six points on)."""
    yd = F.col(y).cast("double")
    recent = _recent_points(df, series, x, y, share, min_rows)
    half = F.floor(F.col("m") / 2)
    fit = recent.groupBy(*series).agg(
        F.max("n").alias("n_points"),
        F.max("m").alias("recent_points"),
        _slope_over_mean(yd).alias("recent_slope"),
        F.avg(F.when(F.col("j") < half, yd)).alias("_a"),
        F.avg(F.when(F.col("j") >= half, yd)).alias("_b"),
    )
    gain = F.when(F.col("_a") > 0, (F.col("_b") - F.col("_a")) / F.col("_a")).otherwise(0.0)
    momentum = F.when(F.col("recent_points") >= 6, gain).otherwise(F.col("recent_slope"))
    fit = fit.withColumn("momentum", momentum)
    s, m = F.col("recent_slope"), F.col("momentum")
    alarm = (
        F.when((s < -MEAN_FLAT) | (m < -MOMENTUM_FLAT), "declining")
        .when((s > MEAN_FLAT) | (m > MOMENTUM_FLAT), "growing")
        .otherwise("stable")
    )
    return fit.withColumn("alarm", alarm).drop("_a", "_b")


def recent_status(
    df: DataFrame,
    series: list[str],
    x: str,
    y: str,
    share: float = 0.2,
    min_rows: int = 3,
    inverse: bool | Column = False,
) -> DataFrame:
    """ok, alarm or stable from the recent slope; ``inverse`` metrics are better when they fall."""
    recent = _recent_points(df, series, x, y, share, min_rows)
    fit = recent.groupBy(*series).agg(
        F.max("n").alias("n_points"), _slope_over_mean(F.col(y).cast("double")).alias("recent_slope")
    )
    turned = F.lit(inverse) if isinstance(inverse, bool) else inverse
    s = F.when(turned, -F.col("recent_slope")).otherwise(F.col("recent_slope"))
    status = F.when(F.col("n_points") < 3, "stable").when(s < -MEAN_FLAT, "alarm").when(s > MEAN_FLAT, "ok").otherwise("stable")
    return fit.withColumn("status", status)


INVERSE_METRICS = ("days_to_churn", "amount_due")


def metric_status(df: DataFrame, metric: str, x: str, y: str) -> DataFrame:
    """Recent status per metric of a long (metric, x, y) table, each in its own sense."""
    return recent_status(df, [metric], x, y, inverse=F.col(metric).isin(*INVERSE_METRICS))


def local_slopes(df: DataFrame, series: list[str], x: str, y: str) -> DataFrame:
    """Slope of the line through each point and its neighbours, up to
    ``min(5, n/4)`` on each side, with a label."""
    points = indexed(df.dropna(subset=[x, y]), series, x)
    reach = F.least(F.lit(MAX_REACH), F.floor(F.col("n") / 4)).cast("int")
    w = W.partitionBy(*series).orderBy(x)
    yd, xd = F.col(y).cast("double"), F.col(x).cast("double")
    slope = F.lit(None).cast("double")
    for k in range(1, MAX_REACH + 1):
        slope = F.when(F.col("_k") == k, F.regr_slope(yd, xd).over(w.rowsBetween(-k, k))).otherwise(slope)
    return (
        points.withColumn("_k", reach)
        .withColumn("local_slope", slope)
        .withColumn("label", F.coalesce(slope_label(F.col("local_slope")), F.lit("stable")))
        .drop("_k")
    )


def central_slopes(df: DataFrame, series: list[str], x: str, y: str) -> DataFrame:
    """Central-difference slope per point, one-sided at the ends."""
    points = df.dropna(subset=[x, y])
    w = W.partitionBy(*series).orderBy(x)
    dx = F.coalesce(F.lead(x).over(w), F.col(x)) - F.coalesce(F.lag(x).over(w), F.col(x))
    dy = F.coalesce(F.lead(y).over(w), F.col(y)) - F.coalesce(F.lag(y).over(w), F.col(y))
    slope = F.coalesce(F.try_divide(dy.cast("double"), dx.cast("double")), F.lit(0.0))
    return points.withColumn("slope", slope).withColumn("label", slope_label(F.col("slope")))


def series_stats(df: DataFrame, series: list[str], y: str) -> DataFrame:
    """Mean, median, sample deviation and count of each series."""
    return df.dropna(subset=[y]).groupBy(*series).agg(
        F.avg(y).alias("mean"), F.median(y).alias("median"), F.stddev_samp(y).alias("std"), F.count(y).alias("n")
    )


def recent_periods(weekly: DataFrame, week: str = "yyyywk", n: int = 12) -> DataFrame:
    return last_rows(weekly, week, n)


def refresh_markers(dates: DataFrame, date: str) -> DataFrame:
    """Week key and month label of data-refresh dates, to join onto weekly or monthly series."""
    return dates.select(
        F.col(date), date_to_week(date).alias("yyyywk"), calendar_parts(date).getField("month_label").alias("month_label")
    )
