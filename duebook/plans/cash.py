"""Weekly cash flow and its forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.operators import cashflow, changepoints
from duebook.session import stage
from duebook.sources.ledger import Ledger

from .common_sql import view
from .foundation import as_double, silver_of
from .registry import query

SEGMENT = ["nation", "sector"]


def weekly_sql(source: str, lead: str = "") -> str:
    return f"""
SELECT *, received - lost AS net,
  CAST((month(week) = 11 AND day(week) >= 20) OR (month(week) = 12 AND day(week) >= 15) AS INTEGER) AS special
FROM (SELECT {lead}CAST(date_trunc('week', due_date) AS DATE) AS week, sum(total_amount) AS expected,
    sum(CASE WHEN days_late <= 0 THEN total_amount ELSE 0 END) AS received,
    sum(CASE WHEN days_late > 0 THEN open_amount ELSE 0 END) AS lost, count(*) AS n_invoices
  FROM {source} GROUP BY ALL)
"""


def fit_sql(points: str) -> str:
    """Least squares of y on t and special per segment, written out as the normal equations."""
    return f"""
SELECT nation, sector, n, last_week, (sy - slope * st - effect * se) / n AS level, slope, effect
FROM (SELECT *, CASE WHEN det > 1e-9 THEN (cty * cee - cey * cte) / det ELSE coalesce(cty / nullif(ctt, 0), 0) END AS slope,
    CASE WHEN det > 1e-9 THEN (cey * ctt - cty * cte) / det ELSE 0.0E0 END AS effect
  FROM (SELECT *, ctt * cee - cte * cte AS det
    FROM (SELECT *, stt - st * st / n AS ctt, ste - st * se / n AS cte, se - se * se / n AS cee,
        sty - st * sy / n AS cty, sey - se * sy / n AS cey
      FROM (SELECT nation, sector, CAST(count(*) AS DOUBLE) AS n, CAST(sum(t) AS DOUBLE) AS st,
          CAST(sum(special) AS DOUBLE) AS se, CAST(sum(t * t) AS DOUBLE) AS stt, CAST(sum(t * special) AS DOUBLE) AS ste,
          CAST(sum(y) AS DOUBLE) AS sy, CAST(sum(t * y) AS DOUBLE) AS sty, CAST(sum(special * y) AS DOUBLE) AS sey,
          max(week) AS last_week
        FROM {points} GROUP BY nation, sector))))
"""


ERRORS = "CAST(y AS DOUBLE) - (level + slope * t + effect * special)"

view("weekly", weekly_sql("silver"), "silver")
view(
    "segment_invoices",
    "SELECT c.nation, c.sector, s.* FROM silver s JOIN customers c ON c.customer_id = s.customer_id",
    "silver",
    "customers",
)
view("segment_weeks", weekly_sql("segment_invoices", "nation, sector, "), "segment_invoices")
view(
    "points",
    """
SELECT nation, sector, week, CAST(date_diff('day', DATE '1970-01-05', week) // 7 AS INTEGER) AS t, special,
  CAST(net AS DECIMAL(24,4)) AS y
FROM (SELECT *, quantile_cont(CAST(net AS DOUBLE), 0.25) OVER w AS q1, quantile_cont(CAST(net AS DOUBLE), 0.75) OVER w AS q3
  FROM segment_weeks WINDOW w AS (PARTITION BY nation, sector))
WHERE NOT (CAST(net AS DOUBLE) < q1 - 3.0E0 * (q3 - q1) OR CAST(net AS DOUBLE) > q3 + 3.0E0 * (q3 - q1))
""",
    "segment_weeks",
)
view("fits", fit_sql("points"), "points")
view(
    "fit_errors",
    f"SELECT p.*, f.n, {ERRORS} AS error, CAST(y AS DOUBLE) AS actual FROM points p JOIN fits f ON f.nation = p.nation AND f.sector = p.sector",
    "points",
    "fits",
)
view(
    "ahead",
    """
SELECT *, CASE WHEN forecast <= 0 THEN 'Critical' WHEN forecast <= 350000 THEN 'Attention'
    WHEN forecast <= 700000 THEN 'Normal' ELSE 'Excellent' END AS cash_band,
  CASE WHEN days_ahead <= 30 THEN '0-30 days' WHEN days_ahead <= 60 THEN '31-60 days' ELSE '61-90 days' END AS horizon
FROM (SELECT nation, sector, week, round(point, 2) AS forecast, round(point - 1.2816E0 * sd, 2) AS lower,
    round(point + 1.2816E0 * sd, 2) AS upper, days_ahead
  FROM (SELECT *, level + slope * (date_diff('day', DATE '1970-01-05', week) // 7) + effect *
      CAST((month(week) = 11 AND day(week) >= 20) OR (month(week) = 12 AND day(week) >= 15) AS INTEGER) AS point
    FROM (SELECT f.*, s.sd, CAST(h * 7 AS INTEGER) AS days_ahead, last_week + CAST(h * 7 AS INTEGER) AS week
      FROM fits f JOIN (SELECT nation, sector, sqrt(sum(error * error) / greatest(max(n) - 3, 1)) AS sd
        FROM fit_errors GROUP BY nation, sector) s ON s.nation = f.nation AND s.sector = f.sector,
        range(1, 14) r(h))))
""",
    "fits",
    "fit_errors",
)


def weekly_of(book: Ledger) -> DataFrame:
    return cashflow.weekly_cashflow(silver_of(book, method=False))


def points_of(book: Ledger) -> DataFrame:
    segments = book.customers().select("customer_id", *SEGMENT)
    invoices = silver_of(book, method=False).select(
        "customer_id", "due_date", "total_amount", "open_amount", "days_late"
    )
    # one row per customer and week before the segment is looked up
    per_customer = cashflow.weekly_cashflow(invoices, ["customer_id"])
    joined = per_customer.join(segments, "customer_id")
    series = joined.groupBy(*SEGMENT, "week", "special").agg(F.sum("net").cast("decimal(28,4)").alias("net"))
    # short series, but every forecast reads them more than once
    return stage(cashflow.clean_series(series, SEGMENT))


WEEKLY = "week, CAST(expected AS DOUBLE) AS expected, CAST(received AS DOUBLE) AS received, CAST(lost AS DOUBLE) AS lost, n_invoices, CAST(net AS DOUBLE) AS net"


@query("weekly_cashflow", f"SELECT {WEEKLY}, special FROM weekly", ("weekly",))
def weekly_cashflow(book: Ledger) -> DataFrame:
    return as_double(weekly_of(book))


@query(
    "iqr_outliers",
    """
SELECT week, CAST(net AS DOUBLE) AS net, round(q1 - 3.0E0 * (q3 - q1), 4) AS lower_fence,
  round(q3 + 3.0E0 * (q3 - q1), 4) AS upper_fence,
  CAST(CAST(net AS DOUBLE) < q1 - 3.0E0 * (q3 - q1) OR CAST(net AS DOUBLE) > q3 + 3.0E0 * (q3 - q1) AS INTEGER) AS is_outlier
FROM weekly, (SELECT quantile_cont(CAST(net AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(net AS DOUBLE), 0.75) AS q3 FROM weekly)
""",
    ("weekly",),
)
def iqr_outliers(book: Ledger) -> DataFrame:
    flagged = cashflow.flag_outliers(weekly_of(book))
    return as_double(flagged).select(
        "week", "net", F.round("lower_fence", 4).alias("lower_fence"), F.round("upper_fence", 4).alias("upper_fence"),
        "is_outlier",
    )


@query("forecast_weekly", "SELECT * FROM ahead", ("ahead",))
def forecast_weekly(book: Ledger) -> DataFrame:
    return cashflow.forecast(points_of(book), SEGMENT)


@query(
    "forecast_windows",
    """
SELECT horizon, count(*) AS n_points, CAST(sum(CAST(forecast AS DECIMAL(18,2))) AS DOUBLE) AS forecast_total,
  count(*) FILTER (cash_band = 'Critical') AS n_critical
FROM ahead GROUP BY horizon
""",
    ("ahead",),
)
def forecast_windows(book: Ledger) -> DataFrame:
    return cashflow.forecast_windows(cashflow.forecast(points_of(book), SEGMENT))


@query(
    "forecast_fit",
    """
SELECT nation, sector, count(*) AS n_points, round(avg(abs(error)), 2) AS mae,
  round(avg(abs(error / nullif(actual, 0))) * 100, 4) AS mape
FROM fit_errors GROUP BY nation, sector
""",
    ("fit_errors",),
)
def forecast_fit(book: Ledger) -> DataFrame:
    points = points_of(book)
    return cashflow.error_summary(cashflow.with_errors(points, cashflow.fit_trend(points, SEGMENT), SEGMENT), SEGMENT)


view(
    "numbered",
    """
SELECT *, least(greatest(size * 8 // 10, size - 13), size - 4) AS n_train FROM (
  SELECT *, row_number() OVER (PARTITION BY nation, sector ORDER BY week) AS i,
    count(*) OVER (PARTITION BY nation, sector) AS size FROM points)
""",
    "points",
)
view("train_points", "SELECT * FROM numbered WHERE i <= n_train", "numbered")
view("train_fits", fit_sql("train_points"), "train_points")


@query(
    "forecast_backtest",
    f"""
SELECT nation, sector, n_train, n_holdout, CASE WHEN n_train >= 10 AND n_holdout >= 3 THEN round(mae, 2) END AS mae,
  CASE WHEN n_train >= 10 AND n_holdout >= 3 THEN round(mape * 100, 4) END AS mape
FROM (SELECT nation, sector, max(n_train) AS n_train, count(*) AS n_holdout, avg(abs(error)) AS mae,
    avg(abs(error / nullif(CAST(y AS DOUBLE), 0))) AS mape
  FROM (SELECT p.*, {ERRORS} AS error FROM numbered p
    JOIN train_fits f ON f.nation = p.nation AND f.sector = p.sector WHERE p.i > p.n_train)
  GROUP BY nation, sector)
""",
    ("numbered", "train_fits"),
)
def forecast_backtest(book: Ledger) -> DataFrame:
    return cashflow.backtest(points_of(book), SEGMENT)


@query(
    "model_card",
    """
SELECT *, CAST(to_json({'n_segments': n_segments, 'n_points': n_points, 'first_week': first_week, 'last_week': last_week,
  'horizon_weeks': horizon_weeks, 'mean_band_width': mean_band_width}) AS VARCHAR) AS card
FROM (SELECT count(*) AS n_segments, CAST(sum(n) AS BIGINT) AS n_points, strftime(min(first), '%Y-%m-%d') AS first_week,
    strftime(max(last), '%Y-%m-%d') AS last_week, 13 AS horizon_weeks,
    (SELECT CAST(round(avg(upper - lower), 0) AS BIGINT) FROM ahead) AS mean_band_width
  FROM (SELECT count(*) AS n, min(week) AS first, max(week) AS last FROM points GROUP BY nation, sector))
""",
    ("points", "ahead"),
)
def model_card(book: Ledger) -> DataFrame:
    points = points_of(book)
    return cashflow.model_card(points, cashflow.forecast(points, SEGMENT), SEGMENT)


def changes_sql(points: str) -> str:
    """The best fit per segment among all sets of candidates for a change."""
    count = changepoints.CANDIDATES
    sums = ", ".join(f"CAST(sum({product}) AS DOUBLE) AS {name}" for name, product in changepoints.normal_sums().items())
    solved = f"""
SELECT nation, sector, i, j, k1, k2, first_t, last_week, CAST(count(*) AS DOUBLE) AS n, {sums}
FROM (SELECT *, CASE WHEN i > 0 THEN greatest(u - k1, 0.0E0) ELSE 0.0E0 END AS h1,
    CASE WHEN j > 0 THEN greatest(u - k2, 0.0E0) ELSE 0.0E0 END AS h2
  FROM (SELECT p.nation, p.sector, p.i, p.j, first_t, last_week, CAST(t - first_t AS DOUBLE) AS u,
      CAST(special AS DOUBLE) AS e, CAST(y AS DOUBLE) AS y,
      CAST({changepoints.place("p.i")} AS INTEGER) AS k1, CAST({changepoints.place("p.j")} AS INTEGER) AS k2
    FROM (SELECT p.* EXCLUDE (i), e.i, e.j, first_t, last_week, span FROM (SELECT *, 0 AS i FROM {points}) p
      JOIN (SELECT nation, sector, min(t) AS first_t, max(week) AS last_week, max(t) - min(t) AS span, a.i, b.j
        FROM {points}, range(0, {count + 1}) a(i), range(0, {count + 1}) b(j) WHERE b.j = 0 OR (a.i > 0 AND b.j > a.i)
        GROUP BY nation, sector, a.i, b.j) e ON e.nation = p.nation AND e.sector = p.sector) p))
GROUP BY nation, sector, i, j, k1, k2, first_t, last_week
"""
    for layer in changepoints.elimination():
        solved = f"SELECT *, {', '.join(f'{expr} AS {name}' for name, expr in layer.items())} FROM ({solved})"
    return f"""
SELECT * FROM (SELECT *, (i > 0)::INTEGER + (j > 0)::INTEGER AS knots FROM ({solved}))
WHERE knots = 0 OR n > 4 + 2 * knots
QUALIFY row_number() OVER (PARTITION BY nation, sector ORDER BY {changepoints.criterion()}, knots, i, j) = 1
"""


def bent_sql(t: str, special: str) -> str:
    bends = " + ".join(f"b_h{n} * greatest(CAST({t} - first_t AS DOUBLE) - k{n}, 0.0E0)" for n in (1, 2))
    return f"level + b_u * CAST({t} - first_t AS DOUBLE) + b_e * {special} + {bends}"


view("change_fits", changes_sql("points"), "points")
view("train_change_fits", changes_sql("(SELECT * EXCLUDE (i) FROM train_points)"), "train_points")


@query(
    "forecast_changepoints",
    f"""
SELECT *, CASE WHEN forecast <= 0 THEN 'Critical' WHEN forecast <= 350000 THEN 'Attention'
    WHEN forecast <= 700000 THEN 'Normal' ELSE 'Excellent' END AS cash_band,
  CASE WHEN days_ahead <= 30 THEN '0-30 days' WHEN days_ahead <= 60 THEN '31-60 days' ELSE '61-90 days' END AS horizon
FROM (SELECT nation, sector, week, round(point, 2) AS forecast, round(point - 1.2816E0 * sd, 2) AS lower,
    round(point + 1.2816E0 * sd, 2) AS upper, days_ahead
  FROM (SELECT *, {bent_sql("(date_diff('day', DATE '1970-01-05', week) // 7)", "CAST((month(week) = 11 AND day(week) >= 20) OR (month(week) = 12 AND day(week) >= 15) AS INTEGER)")} AS point
    FROM (SELECT *, sqrt(sse / greatest(n - 3 - 2 * knots, 1)) AS sd, CAST(h * 7 AS INTEGER) AS days_ahead,
        last_week + CAST(h * 7 AS INTEGER) AS week FROM change_fits, range(1, 14) r(h))))
""",
    ("change_fits",),
)
def forecast_changepoints(book: Ledger) -> DataFrame:
    return changepoints.forecast(points_of(book), SEGMENT)


@query(
    "forecast_change_backtest",
    f"""
SELECT b.nation, b.sector, b.n_train, b.n_holdout,
  CASE WHEN b.n_train >= 10 AND b.n_holdout >= 3 THEN round(b.mae, 2) END AS mae_bent,
  CASE WHEN b.n_train >= 10 AND b.n_holdout >= 3 THEN round(s.mae, 2) END AS mae_straight
FROM (SELECT p.nation, p.sector, max(p.n_train) AS n_train, count(*) AS n_holdout,
    avg(abs(CAST(y AS DOUBLE) - ({bent_sql("t", "special")}))) AS mae
  FROM numbered p JOIN train_change_fits f ON f.nation = p.nation AND f.sector = p.sector WHERE p.i > p.n_train
  GROUP BY p.nation, p.sector) b
JOIN (SELECT p.nation, p.sector, avg(abs({ERRORS})) AS mae FROM numbered p
    JOIN train_fits f ON f.nation = p.nation AND f.sector = p.sector WHERE p.i > p.n_train
  GROUP BY p.nation, p.sector) s ON s.nation = b.nation AND s.sector = b.sector
""",
    ("numbered", "train_change_fits", "train_fits"),
)
def forecast_change_backtest(book: Ledger) -> DataFrame:
    return changepoints.backtest(points_of(book), SEGMENT)
