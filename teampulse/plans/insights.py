"""Analytics derived from the leaderboard.

Input is a page of the leaderboard (at most 20 rows, see ``leaderboard_page``):
field-wide figures are windows over it, so the board is computed once. Thresholds are
doubles on purpose (``lit(1.2)`` is a double, a bare ``1.2`` in SQL is a
decimal).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from teampulse import constants as K

ID = ["engineer_login", "avatar_url"]


def _d(x: float) -> Column:
    return F.lit(float(x))


def _chain(cases: list[tuple[Column, str]], default: str) -> Column:
    expr = None
    for cond, label in cases:
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def profile_badge_relative(lb: DataFrame) -> DataFrame:
    """Badge against the averages of the rows shown."""
    field = Window.partitionBy()  # the rows shown, at most a page
    mean = lambda v: F.sum(v).over(field) / F.count(F.lit(1)).over(field)
    x = lb.withColumns({"_avg_prs": mean("prs_merged"), "_avg_reviews": mean("reviews")})
    c = F.col
    high_ship = c("prs_merged") > c("_avg_prs") * _d(K.REL_SHIP_FACTOR)
    high_rev = c("reviews") > c("_avg_reviews") * _d(K.REL_REVIEW_FACTOR)
    catches = c("changes_requested") >= K.REL_CATCHES_MIN
    ship_pts = c("prs_merged") * K.W_PRS
    rev_pts = c("reviews") * K.W_REVIEWS + c("changes_requested") * K.W_CHANGES
    rev_dom = rev_pts > ship_pts * _d(K.REL_REVIEW_DOMINANCE)
    badge = _chain([
        (high_ship & high_rev & catches, K.ALL_ROUNDER),
        (catches & rev_dom, K.QUALITY_GUARDIAN),
        (high_ship & high_rev, K.SHIPPING_REVIEWER),
        (high_ship & (c("commits") > K.REL_PROLIFIC_COMMITS), K.PROLIFIC_SHIPPER),
        (rev_dom, K.CODE_REVIEWER),
        (high_ship, K.FEATURE_SHIPPER),
        (c("commits") > c("_avg_prs") * _d(K.REL_ENGINE_FACTOR), K.CODE_ENGINE),
    ], K.CONTRIBUTOR)
    return x.select(*ID, "impact_rank", badge.alias("profile"))


def profile_badge_absolute(lb: DataFrame) -> DataFrame:
    """Badge from fixed thresholds."""
    c = F.col
    ship_score = c("prs_merged") * K.W_PRS
    review_score = c("reviews") * K.W_REVIEWS + c("changes_requested") * K.W_CHANGES
    shipper = c("prs_merged") >= K.ABS_SHIPPER_PRS
    reviewer = c("reviews") >= K.ABS_REVIEWER_REVIEWS
    catcher = c("changes_requested") >= K.ABS_CATCHER_CHANGES
    engine = (c("commits") >= K.ABS_ENGINE_COMMITS) & (ship_score < c("commits") * K.ABS_ENGINE_RATIO)
    rev_dom = review_score > ship_score * _d(K.ABS_REVIEW_DOMINANCE)
    badge = _chain([
        (shipper & reviewer & catcher, K.ALL_ROUNDER),
        (catcher & rev_dom, K.QUALITY_GUARDIAN),
        (shipper & reviewer, K.SHIPPING_REVIEWER),
        (engine, K.CODE_ENGINE),
        (rev_dom, K.CODE_REVIEWER),
        (shipper, K.FEATURE_SHIPPER),
    ], K.CONTRIBUTOR)
    return lb.select(*ID, "impact_rank", badge.alias("profile"))


def _unpivot(lb: DataFrame, parts: tuple[tuple[str, str], ...], value_name: str) -> DataFrame:
    """Long rows (id, component_order, component, value) via ``stack``."""
    args = ", ".join(f"{i}, '{label}', CAST({col} AS BIGINT)" for i, (label, col) in enumerate(parts))
    expr = f"stack({len(parts)}, {args}) AS (component_order, component, {value_name})"
    return lb.select(*ID, "impact_score", F.expr(expr))


def score_composition(lb: DataFrame) -> DataFrame:
    """D3: five components (approvals omitted), positive points only, share
    of the score (a zero score divides by 1)."""
    long = _unpivot(lb, K.COMPOSITION, "points").where(F.col("points") > 0)
    total = F.when(F.col("impact_score") == 0, _d(1)).otherwise(F.col("impact_score"))
    return long.select(*ID, F.col("component_order").cast("int"), "component", "points",
                       (F.col("points") / total * _d(100)).alias("share"))


def score_breakdown(lb: DataFrame) -> DataFrame:
    """Six components with bar width min(100, points / score * 100);
    NULL for a zero score."""
    long = _unpivot(lb, K.BREAKDOWN, "points")
    pct = F.least(_d(100), F.try_divide(F.col("points"), F.col("impact_score")) * _d(100))
    return long.select(*ID, F.col("component_order").cast("int"), "component", "points", pct.alias("pct"))


def metric_fill(lb: DataFrame) -> DataFrame:
    """Four metric bars, min(100, value / max * 100)."""
    args = ", ".join(f"{i}, '{label}', CAST({col} AS BIGINT), {mx}"
                     for i, (label, col, mx) in enumerate(K.METRIC_MAXIMA))
    long = lb.select(*ID, F.expr(f"stack({len(K.METRIC_MAXIMA)}, {args}) "
                                 "AS (metric_order, metric, value, max_value)"))
    return long.select(*ID, F.col("metric_order").cast("int"), "metric", "value",
                       F.least(_d(100), F.col("value") / F.col("max_value").cast("double") * _d(100))
                       .alias("pct"))


def _positions(lb: DataFrame) -> DataFrame:
    order = [F.col("impact_score").desc(), F.col("engineer_login"), F.col("avatar_url")]
    return lb.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def podium(lb: DataFrame) -> DataFrame:
    """Positions 1-3 (dense, ties broken by order) when the board has
    at least three rows; ``slot`` is the display order 2-1-3."""
    p = _positions(lb).withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy()))
    slot = F.when(F.col("position") == 2, 1).when(F.col("position") == 1, 2).otherwise(3)
    return (p.where((F.col("_rows") >= K.PODIUM_SIZE) & (F.col("position") <= K.PODIUM_SIZE))
             .select(*ID, "impact_score", "impact_rank", F.col("position").cast("int"),
                     slot.alias("slot")))


def team_insight(lb: DataFrame) -> DataFrame:
    """One row. Top shipper / reviewer are arg-max with the *later* row
    winning ties; the reviewer is blanked when it is the top shipper; the
    ship/review ratio is rounded half-up to one decimal and NULL when there
    is no review activity. An empty board has totals 0."""
    p = _positions(lb)
    rev = F.col("reviews") + F.col("changes_requested")
    g = p.agg(
        F.sum(F.col("prs_merged") * K.W_PRS).alias("total_shipping"),
        F.sum(F.col("reviews") * K.W_REVIEWS + F.col("changes_requested") * K.W_CHANGES).alias("total_reviewing"),
        F.max_by("engineer_login", F.struct(F.col("prs_merged"), F.col("position"))).alias("top_shipper"),
        F.max(F.col("prs_merged")).alias("top_shipper_prs"),
        F.max_by("engineer_login", F.struct(rev, F.col("position"))).alias("_top_reviewer"),
        F.max(rev).alias("_top_review_count"))
    same = F.col("_top_reviewer") == F.col("top_shipper")
    g = g.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("total_shipping", "total_reviewing")})
    return g.select(
        "total_shipping", "total_reviewing",
        F.when(F.col("total_reviewing") > 0,
               F.round(F.col("total_shipping") / F.col("total_reviewing").cast("double"), 1))
         .alias("ship_review_ratio"),
        (F.col("total_reviewing") > F.col("total_shipping")).alias("review_heavy"),
        "top_shipper", F.col("top_shipper_prs").cast("long").alias("top_shipper_prs"),
        F.when(~same, F.col("_top_reviewer")).alias("top_reviewer"),
        F.when(~same, F.col("_top_review_count")).cast("long").alias("top_reviewer_reviews"))


def trend_series(trends: DataFrame) -> DataFrame:
    """Weekly trends as chart series (week, series, value)."""
    args = ", ".join(f"{i}, '{label}', CAST({col} AS BIGINT)" for i, (label, col) in enumerate(K.TREND_SERIES))
    return trends.select(F.col("week_start").alias("week"),
                         F.expr(f"stack({len(K.TREND_SERIES)}, {args}) AS (series_order, series, value)"))
