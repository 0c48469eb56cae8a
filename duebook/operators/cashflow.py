"""Weekly cash flow, its outliers, and a trend-and-event forecast per segment with a walk-forward backtest.

The first aggregate reduces invoices to one row per segment and week; from there a series is as long as the calendar,
and every segment is fitted in the same job from exact sums.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook.functions.bands import right_closed

# Forecast horizon, fence width, interval width, cash bands and windows.
HORIZON_WEEKS = 13
FENCE_IQRS = 3.0
INTERVAL_Z = 1.2816
CASH_EDGES = (float("-inf"), 0, 350000, 700000, float("inf"))
CASH_LABELS = ("Critical", "Attention", "Normal", "Excellent")
WINDOW_EDGES = (0, 30, 60, 91)
WINDOW_LABELS = ("0-30 days", "31-60 days", "61-90 days")
FIRST_MONDAY = "1970-01-05"
MIN_TRAIN, MIN_HOLDOUT, SPARE_HOLDOUT = 10, 3, 4


def special_week(day: Column) -> Column:
    """1 for Mondays from 20 November and from 15 December to the end of the month."""
    month, dom = F.month(day), F.dayofmonth(day)
    return (((month == 11) & (dom >= 20)) | ((month == 12) & (dom >= 15))).cast("int")


def weekly_cashflow(invoices: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Billed, received on time and lost per Monday week of the due date; net is received minus lost."""
    late, zero2, zero4 = F.col("days_late") > 0, F.lit(0).cast("decimal(18,2)"), F.lit(0).cast("decimal(18,4)")
    week = F.date_trunc("week", F.col("due_date")).cast("date")
    grouped = invoices.groupBy(*by, week.alias("week")).agg(
        F.sum("total_amount").alias("expected"),
        F.sum(F.when(~late, F.col("total_amount")).otherwise(zero2)).alias("received"),
        F.sum(F.when(late, F.col("open_amount")).otherwise(zero4)).alias("lost"),
        F.count(F.lit(1)).alias("n_invoices"),
    )
    return grouped.withColumn("net", (F.col("received") - F.col("lost")).cast("decimal(28,4)")).withColumn(
        "special", special_week(F.col("week"))
    )


def fences(series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles of the weekly net and the fences three interquartile ranges outside them."""
    quartiles = F.percentile(F.col("net").cast("double"), F.array(F.lit(0.25), F.lit(0.75)))
    q1, q3 = F.col("q").getItem(0), F.col("q").getItem(1)
    return (
        series.groupBy(*by)
        .agg(quartiles.alias("q"))
        .select(
            *by,
            (q1 - FENCE_IQRS * (q3 - q1)).alias("lower_fence"),
            (q3 + FENCE_IQRS * (q3 - q1)).alias("upper_fence"),
        )
    )


def flag_outliers(series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    net = F.col("net").cast("double")
    if by:
        fenced = series.join(fences(series, by), list(by))
    else:
        one_row = fences(series)
        fenced = series.withColumns(
            {c: one_row.select(c).scalar() for c in ("lower_fence", "upper_fence")}
        )
    outside = (net < F.col("lower_fence")) | (net > F.col("upper_fence"))
    return fenced.withColumn("is_outlier", outside.cast("int"))


def clean_series(series: DataFrame, by: Sequence[str]) -> DataFrame:
    """The points inside the fences, as ``(by…, week, t, special, y)``."""
    inside = flag_outliers(series, by).filter(F.col("is_outlier") == 0)
    t = F.datediff(F.col("week"), F.lit(FIRST_MONDAY).cast("date")) / 7
    return inside.select(*by, "week", t.cast("int").alias("t"), "special", F.col("net").alias("y"))


def fit_trend(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """Least squares of ``y`` on week number and special-week flag, in closed form per segment."""
    t, e, y = F.col("t").cast("decimal(10,0)"), F.col("special"), F.col("y")
    d = "double"
    sums = points.groupBy(*by).agg(
        F.count(F.lit(1)).cast(d).alias("n"),
        F.sum("t").cast(d).alias("st"),
        F.sum(e).cast(d).alias("se"),
        F.sum(F.col("t").cast("bigint") * F.col("t")).cast(d).alias("stt"),
        F.sum(F.col("t") * e).cast(d).alias("ste"),
        F.sum(y).cast(d).alias("sy"),
        F.sum(t * y).cast(d).alias("sty"),
        F.sum(F.when(e == 1, y).otherwise(F.lit(0).cast("decimal(28,4)"))).cast(d).alias("sey"),
        F.max("week").alias("last_week"),
    )
    n = F.col("n")

    def centred(product: str, a: str, b: str) -> Column:
        return F.col(product) - F.col(a) * F.col(b) / n

    moments = sums.select(
        "*",
        centred("stt", "st", "st").alias("ctt"),
        centred("ste", "st", "se").alias("cte"),
        centred("se", "se", "se").alias("cee"),
        centred("sty", "st", "sy").alias("cty"),
        centred("sey", "se", "sy").alias("cey"),
    )
    ctt, cte, cee, cty, cey = (F.col(c) for c in ("ctt", "cte", "cee", "cty", "cey"))
    det = ctt * cee - cte * cte
    solvable = det > 1e-9
    slope = F.when(solvable, F.try_divide(cty * cee - cey * cte, det)).otherwise(
        F.coalesce(F.try_divide(cty, ctt), F.lit(0.0))
    )
    effect = F.when(solvable, F.try_divide(cey * ctt - cty * cte, det)).otherwise(0.0)
    fitted = moments.select(*by, "n", "last_week", "st", "se", "sy", slope.alias("slope"), effect.alias("effect"))
    level = (F.col("sy") - F.col("slope") * F.col("st") - F.col("effect") * F.col("se")) / F.col("n")
    return fitted.select(*by, "n", "last_week", level.alias("level"), "slope", "effect")


def predicted(t: Column, special: Column) -> Column:
    return F.col("level") + F.col("slope") * t + F.col("effect") * special


def with_errors(points: DataFrame, fit: DataFrame, by: Sequence[str]) -> DataFrame:
    joined = points.join(fit, list(by))
    y = F.col("y").cast("double")
    return joined.withColumn("error", y - predicted(F.col("t"), F.col("special"))).withColumn("actual", y)


def error_summary(errors: DataFrame, by: Sequence[str]) -> DataFrame:
    """MAE, and MAPE over the points whose actual value is not 0."""
    return errors.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.round(F.avg(F.abs("error")), 2).alias("mae"),
        F.round(F.avg(F.abs(F.try_divide(F.col("error"), F.col("actual")))) * 100, 4).alias("mape"),
    )


def forecast(points: DataFrame, by: Sequence[str], weeks: int = HORIZON_WEEKS) -> DataFrame:
    """The next ``weeks`` Mondays per segment: point, interval, cash band, days ahead and window."""
    fit = fit_trend(points, by)
    spread = with_errors(points, fit, by).groupBy(*by).agg(
        F.sqrt(F.try_divide(F.sum(F.col("error") * F.col("error")), F.greatest(F.max("n") - 3, F.lit(1.0)))).alias("sd")
    )
    return project(fit.join(spread, list(by)), by, weeks, predicted)


def project(fit: DataFrame, by: Sequence[str], weeks: int, value: Callable[[Column, Column], Column]) -> DataFrame:
    """The Mondays after ``last_week`` along ``value`` of week number and special-week flag, give or take ``sd``."""
    ahead = fit.select("*", F.explode(F.sequence(F.lit(7), F.lit(7 * weeks), F.lit(7))).alias("days_ahead"))
    week = F.date_add(F.col("last_week"), F.col("days_ahead"))
    t = (F.datediff(week, F.lit(FIRST_MONDAY).cast("date")) / 7).cast("int")
    point = value(t, special_week(week))
    return ahead.select(
        *by,
        week.alias("week"),
        F.round(point, 2).alias("forecast"),
        F.round(point - INTERVAL_Z * F.col("sd"), 2).alias("lower"),
        F.round(point + INTERVAL_Z * F.col("sd"), 2).alias("upper"),
        "days_ahead",
    ).select(
        "*",
        right_closed(F.col("forecast"), CASH_EDGES, CASH_LABELS).alias("cash_band"),
        right_closed(F.col("days_ahead"), WINDOW_EDGES, WINDOW_LABELS).alias("horizon"),
    )


def forecast_windows(ahead: DataFrame) -> DataFrame:
    total = F.sum(F.col("forecast").cast("decimal(18,2)")).cast("double")
    critical = F.count(F.when(F.col("cash_band") == CASH_LABELS[0], 1))
    return ahead.groupBy("horizon").agg(
        F.count(F.lit(1)).alias("n_points"), total.alias("forecast_total"), critical.alias("n_critical")
    )


def holdout(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """Adds the place ``i`` in the series and ``n_train``, the size of its training part.

    The training part is 80 %, raised so that the test part has at most 13 weeks, lowered so that it has at least 4.
    """
    # a segment's series is bounded by the calendar, so its window is small whatever the invoice count
    order = Window.partitionBy(*by).orderBy("week")
    numbered = points.withColumn("i", F.row_number().over(order)).withColumn(
        "size", F.count(F.lit(1)).over(Window.partitionBy(*by))
    )
    share = F.floor(F.col("size") * 8 / 10)
    n_train = F.least(F.greatest(share, F.col("size") - HORIZON_WEEKS), F.col("size") - SPARE_HOLDOUT)
    return numbered.withColumn("n_train", n_train.cast("bigint"))


def backtest(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """Fits the first part of each series and measures the rest; short series get no error figures."""
    parts = holdout(points, by)
    fit = fit_trend(parts.filter(F.col("i") <= F.col("n_train")), by)
    held = with_errors(parts.filter(F.col("i") > F.col("n_train")), fit, by)
    tested = held.groupBy(*by).agg(
        F.max("n_train").alias("n_train"),
        F.count(F.lit(1)).alias("n_holdout"),
        F.avg(F.abs("error")).alias("mae"),
        F.avg(F.abs(F.try_divide(F.col("error"), F.col("actual")))).alias("mape"),
    )
    enough = (F.col("n_train") >= MIN_TRAIN) & (F.col("n_holdout") >= MIN_HOLDOUT)
    return tested.select(
        *by,
        "n_train",
        "n_holdout",
        F.when(enough, F.round("mae", 2)).alias("mae"),
        F.when(enough, F.round(F.col("mape") * 100, 4)).alias("mape"),
    )


def model_card(points: DataFrame, ahead: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row that documents the forecast: period, sizes, mean band width, and the same as JSON."""
    series = points.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min("week").alias("first"), F.max("week").alias("last")
    )
    facts = series.agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.sum("n").alias("n_points"),
        F.date_format(F.min("first"), "yyyy-MM-dd").alias("first_week"),
        F.date_format(F.max("last"), "yyyy-MM-dd").alias("last_week"),
    )
    width = ahead.agg(F.round(F.avg(F.col("upper") - F.col("lower")), 0).cast("bigint")).scalar()
    card = facts.select("*", F.lit(HORIZON_WEEKS).alias("horizon_weeks"), width.alias("mean_band_width"))
    return card.select("*", F.to_json(F.struct(*card.columns)).alias("card"))
