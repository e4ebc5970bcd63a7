"""Trend, smoothing and health of weekly series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import trend as G
from tidemark.plans.inputs import Inputs, week_sql
from tidemark.plans.registry import add, longs, rounded, shown

# Positions within each segment's weekly series: y documents, x the position itself.
POINTS = """pts AS (SELECT segment, yyyywk, documents_opened::DOUBLE AS y, row_number() OVER (PARTITION BY segment ORDER BY yyyywk) - 1 AS i,
    count(*) OVER (PARTITION BY segment) AS n FROM weekly_segments WHERE documents_opened IS NOT NULL)"""


def series(t: Inputs) -> DataFrame:
    """Weekly documents per segment with the position as x."""
    return G.indexed(t.weekly_segments.dropna(subset=["documents_opened"]), ["segment"], "yyyywk").select("segment", "yyyywk", F.col("i").alias("x"), F.col("documents_opened").alias("y"))


add(
    "linear_trends", "G1 G2",
    lambda t: rounded(G.linear_trend(t.weekly_segments, ["segment"], "yyyywk", "documents_opened")),
    f"""WITH {POINTS} SELECT segment, count(*) AS n_points, round(regr_slope(y, i), 6) AS slope, round(regr_intercept(y, i), 6) AS intercept,
        CASE WHEN regr_slope(y, i) >= 0 THEN 'positive' ELSE 'alarm' END AS direction,
        CASE WHEN regr_slope(y, i) < -0.01 THEN 'declining' WHEN regr_slope(y, i) > 0.01 THEN 'growing' ELSE 'stable' END AS label FROM pts GROUP BY 1""",
)
add(
    "trend_lines", "G1 G3",
    lambda t: shown(
        G.trend_line(
            t.weekly.groupBy("segment", "yyyywk").agg(F.sum("documents_opened").alias("total"), F.avg("documents_opened").alias("level")),
            ["segment"], "yyyywk", "total", "level",
        ), 5
    ),
    """WITH b AS (SELECT segment, yyyywk, sum(documents_opened)::BIGINT AS total, avg(documents_opened) AS lev,
            row_number() OVER (PARTITION BY segment ORDER BY yyyywk) - 1 AS i FROM weekly GROUP BY 1, 2 HAVING sum(documents_opened) IS NOT NULL),
        f AS (SELECT segment, regr_slope(total, i) AS s, regr_intercept(total, i) AS c, avg(lev) / avg(total) AS k FROM b GROUP BY 1)
        SELECT b.segment, yyyywk::BIGINT AS yyyywk, total, round(greatest(c + s * i, 0), 5) AS fitted, round(greatest(c + s * i, 0) * k, 5) AS fitted_scaled
        FROM b JOIN f USING (segment)""",
)
add("lowess_by_segment", "G4", lambda t: rounded(G.lowess(series(t), ["segment"], "x", "y")))
add(
    "lowess_local_slopes", "G4 W10 W11",
    lambda t: rounded(
        G.central_slopes(
            G.local_slopes(G.lowess(series(t), ["segment"], "x", "y"), ["segment"], "x", "smoothed").drop("i", "n").withColumnRenamed("label", "local_label"),
            ["segment"], "x", "smoothed",
        )
    ),
)
DERIVED = f"""{POINTS}, der AS (SELECT *, y - lag(y) OVER (PARTITION BY segment ORDER BY i) AS d FROM pts),
    smo AS (SELECT *, (coalesce(lag(d) OVER w, d) + d + coalesce(lead(d) OVER w, d)) / 3 AS sd FROM der WINDOW w AS (PARTITION BY segment ORDER BY i)),
    sig AS (SELECT *, sd > 0 AS up, lag(sd > 0) OVER (PARTITION BY segment ORDER BY i) AS was FROM smo),
    inf AS (SELECT *, CASE WHEN was AND NOT up THEN 'growth_to_decline' WHEN NOT was AND up THEN 'decline_to_growth' END AS change FROM sig WHERE n >= 5)"""
add(
    "smoothed_derivatives", "W7 W7e",
    lambda t: shown(G.smoothed_derivative(series(t), ["segment"], "x", "y").select("segment", "x", "derivative", "smoothed_slope")),
    f"WITH {DERIVED} SELECT segment, i AS x, d AS derivative, round(sd, 6) AS smoothed_slope FROM smo",
)
add(
    "inflection_points", "W7",
    lambda t: longs(G.inflections(series(t), ["segment"], "x", "y")),
    f"WITH {DERIVED} SELECT segment, i AS x, y::BIGINT AS y, i, change FROM inf WHERE change IS NOT NULL",
)
HEALTH = f"""{DERIVED}, st AS (SELECT segment, count(*) AS n_points, max(y) - min(y) AS yr,
        regr_slope(y, i) * (max(i) - min(i)) / (max(y) - min(y)) AS o,
        regr_slope(y, i) FILTER (WHERE i >= floor(n * 0.7)) * (max(i) FILTER (WHERE i >= floor(n * 0.7)) - min(i) FILTER (WHERE i >= floor(n * 0.7)))
            / (max(y) FILTER (WHERE i >= floor(n * 0.7)) - min(y) FILTER (WHERE i >= floor(n * 0.7))) AS r FROM pts GROUP BY 1),
    tu AS (SELECT segment, count(*) FILTER (WHERE change = 'growth_to_decline') AS d FROM inf GROUP BY 1)"""
add(
    "trend_health", "G5",
    lambda t: shown(G.trend_health(series(t), ["segment"], "x", "y")),
    f"""WITH {HEALTH} SELECT segment, n_points, round(o, 6) AS relative_slope, round(r, 6) AS recent_slope, d AS growth_to_decline,
        CASE WHEN yr = 0 THEN 'stable' WHEN r < -0.1 OR (d > 0 AND r <= 0) THEN 'decreasing'
             WHEN o > 0.1 AND r >= 0 THEN CASE WHEN d > 0 THEN 'mixed' ELSE 'increasing' END ELSE 'stable' END AS status
        FROM st JOIN tu USING (segment)""",
)
add(
    "recent_direction", "G6",
    lambda t: shown(G.recent_direction(series(t), ["segment"], "x", "y")),
    f"""WITH {POINTS}, f AS (SELECT segment, count(*) AS n_points, regr_slope(y, i) FILTER (WHERE i >= n - greatest(5, n // 5)) * (max(i) - min(i)) / (max(y) - min(y)) AS s
        FROM pts GROUP BY 1) SELECT segment, n_points, round(s, 6) AS relative_slope,
        CASE WHEN s > 0.05 THEN 'increasing' WHEN s < -0.05 THEN 'decreasing' ELSE 'stable' END AS direction FROM f""",
)
add("recent_direction_smoothed", "G4 G6", lambda t: shown(G.recent_direction(G.lowess(series(t), ["segment"], "x", "y"), ["segment"], "x", "smoothed")))
LATE = """late AS (SELECT *, i - (n - m) AS j FROM (SELECT *, least(greatest({least}, CAST(floor(n * {share}) AS BIGINT)), n) AS m FROM pts) WHERE i >= n - m)"""
add(
    "recent_alarm", "G7",
    lambda t: shown(G.recent_alarm(series(t), ["segment"], "x", "y")),
    f"""WITH {POINTS}, {LATE.format(least=3, share=0.3)}, f AS (SELECT segment, max(n) AS n_points, max(m) AS recent_points, regr_slope(y, j) / avg(y) AS s,
        avg(y) FILTER (WHERE j < m // 2) AS a, avg(y) FILTER (WHERE j >= m // 2) AS b FROM late GROUP BY 1)
        SELECT segment, n_points, recent_points, round(s, 6) AS recent_slope, round((b - a) / a, 6) AS momentum,
        CASE WHEN s < -0.001 OR (b - a) / a < -0.05 THEN 'declining' WHEN s > 0.001 OR (b - a) / a > 0.05 THEN 'growing' ELSE 'stable' END AS alarm FROM f""",
)


def long_metrics(t: Inputs) -> DataFrame:
    """(metric, week position, value) of three weekly metrics, one of which is better when it falls."""
    w = G.indexed(t.weekly_totals, [], "yyyywk")
    cells = F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(c).alias("y"))
        for name, c in (("documents_opened", "documents_opened"), ("storage_mb", "storage_mb"), ("amount_due", "storage_mb"))
    ])
    return w.select(F.col("i").alias("x"), F.explode(cells).alias("c")).select("x", "c.*")


STATUS = f"""WITH pts AS (SELECT metric, y::DOUBLE AS y, row_number() OVER (PARTITION BY metric ORDER BY yyyywk) - 1 AS i, count(*) OVER (PARTITION BY metric) AS n FROM (
        SELECT 'documents_opened' AS metric, yyyywk, documents_opened AS y FROM weekly_totals UNION ALL SELECT 'storage_mb', yyyywk, storage_mb FROM weekly_totals
        UNION ALL SELECT 'amount_due', yyyywk, storage_mb FROM weekly_totals) WHERE y IS NOT NULL),
    {LATE.format(least=3, share=0.2)}, f AS (SELECT metric, max(n) AS n_points, regr_slope(y, j) / avg(y) AS s FROM late GROUP BY 1),
    g AS (SELECT *, CASE WHEN metric = 'amount_due' THEN -s ELSE s END AS v FROM f)
    SELECT metric, n_points, round(s, 6) AS recent_slope, CASE WHEN v < -0.001 THEN 'alarm' WHEN v > 0.001 THEN 'ok' ELSE 'stable' END AS status FROM g"""
add("metric_status", "G8 G11", lambda t: shown(G.metric_status(long_metrics(t), "metric", "x", "y")), STATUS)
SLOPES = " ".join(
    f"WHEN {k} THEN regr_slope(y, i) OVER (PARTITION BY segment ORDER BY i ROWS BETWEEN {k} PRECEDING AND {k} FOLLOWING)" for k in range(1, 6)
)
add(
    "local_slopes", "W10 G2",
    lambda t: shown(G.local_slopes(series(t), ["segment"], "x", "y").select("segment", "x", "local_slope", "label")),
    f"""WITH {POINTS}, s AS (SELECT segment, i, CASE least(5, n // 4) {SLOPES} END AS v FROM pts) SELECT segment, i AS x, round(v, 6) AS local_slope,
        CASE WHEN round(v, 9) < -0.01 THEN 'declining' WHEN round(v, 9) > 0.01 THEN 'growing' ELSE 'stable' END AS label FROM s""",
)
add(
    "central_slopes", "W11",
    lambda t: shown(G.central_slopes(series(t), ["segment"], "x", "y").select("segment", "x", "slope", "label")),
    f"""WITH {POINTS}, s AS (SELECT segment, i, coalesce((coalesce(lead(y) OVER w, y) - coalesce(lag(y) OVER w, y))
        / nullif(coalesce(lead(i) OVER w, i) - coalesce(lag(i) OVER w, i), 0), 0) AS v FROM pts WINDOW w AS (PARTITION BY segment ORDER BY i))
        SELECT segment, i AS x, round(v, 6) AS slope, CASE WHEN v < -0.01 THEN 'declining' WHEN v > 0.01 THEN 'growing' ELSE 'stable' END AS label FROM s""",
)
add(
    "series_stats", "G9",
    lambda t: rounded(G.series_stats(series(t), ["segment"], "y")),
    f"""WITH {POINTS} SELECT segment, round(avg(y), 6) AS mean, median(y)::DOUBLE AS median, round(stddev_samp(y), 6) AS std, count(*) AS n FROM pts GROUP BY 1""",
)
add(
    "refresh_markers", "G10",
    lambda t: longs(
        G.refresh_markers(t.orders.groupBy(F.year("o_orderdate").alias("y")).agg(F.max("o_orderdate").alias("refreshed")), "refreshed")
        .join(t.weekly_totals.select("yyyywk", "documents_opened"), "yyyywk", "left")
    ),
    f"""SELECT refreshed, yyyywk::BIGINT AS yyyywk, strftime(refreshed, '%Y-%m') AS month_label, documents_opened FROM (
        SELECT refreshed, {week_sql('refreshed')} AS yyyywk FROM (SELECT max(o_orderdate) AS refreshed FROM ord GROUP BY year(o_orderdate)))
        LEFT JOIN weekly_totals USING (yyyywk)""",
)
add(
    "last_weeks", "W9",
    lambda t: longs(G.recent_periods(t.weekly_totals, n=20)),
    "SELECT * REPLACE (yyyywk::BIGINT AS yyyywk) FROM weekly_totals ORDER BY yyyywk DESC LIMIT 20",
)
