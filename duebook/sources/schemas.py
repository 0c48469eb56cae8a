"""Schemas of the tables that jobs write. ``conform`` casts a frame to one by name, so that appends never drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


LONG, INT, DOUBLE, TEXT, DATE = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.DateType()
MOMENT = T.TimestampType()
MONEY, FINE_MONEY = T.DecimalType(18, 2), T.DecimalType(18, 4)


def table(keys: tuple[str, ...] = (), **columns: T.DataType) -> T.StructType:
    """Columns in the order given; ``keys`` are not nullable."""
    return T.StructType([T.StructField(name, kind, name not in keys) for name, kind in columns.items()])


CUSTOMERS = table(
    keys=("customer_id",),
    customer_id=LONG,
    name=TEXT,
    sector=TEXT,
    size_band=TEXT,
    nation=TEXT,
)
INVOICES = table(
    keys=("invoice_id", "customer_id"),
    invoice_id=LONG,
    customer_id=LONG,
    amount=MONEY,
    issue_date=DATE,
    due_date=DATE,
    status=TEXT,
    issue_month=TEXT,
)
PAYMENTS = table(
    keys=("invoice_id",),
    invoice_id=LONG,
    line_no=INT,
    part_id=LONG,
    supplier_id=LONG,
    amount=FINE_MONEY,
    payment_date=DATE,
    method=TEXT,
)
METRIC_LOG = table(
    keys=("metric_id",),
    metric_id=TEXT,
    version=TEXT,
    period=INT,
    period_start=DATE,
    period_end=DATE,
    n_predictions=LONG,
    n_high_risk=LONG,
    n_medium_risk=LONG,
    n_low_risk=LONG,
    avg_score=DOUBLE,
    median_score=DOUBLE,
    accuracy=DOUBLE,
    precision=DOUBLE,
    recall=DOUBLE,
    f1=DOUBLE,
    f1_weighted=DOUBLE,
    auc=DOUBLE,
    actual_default_rate=DOUBLE,
    predicted_default_rate=DOUBLE,
)
ALERTS = table(
    version=TEXT,
    period_end=DATE,
    status=TEXT,
    alert_type=TEXT,
    severity=TEXT,
    metric_name=TEXT,
    current_value=DOUBLE,
    threshold_value=DOUBLE,
    deviation=DOUBLE,
    message=TEXT,
)
VERSIONS = table(
    keys=("version_id",),
    version_id=TEXT,
    version_number=INT,
    model=TEXT,
    trained_on=DATE,
    variant=TEXT,
    auc=DOUBLE,
    f1=DOUBLE,
    precision=DOUBLE,
    recall=DOUBLE,
    status=TEXT,
)
MONITORING = table(
    n_drifted=LONG,
    n_features=LONG,
    n_predictions=LONG,
    mean_probability=DOUBLE,
    critical_pct=DOUBLE,
    drift_pct=DOUBLE,
    drift_alert=INT,
    critical_alert=INT,
    status=TEXT,
)
EXPERIMENTS = table(
    n_control=LONG,
    n_treatment=LONG,
    rate_control=DOUBLE,
    rate_treatment=DOUBLE,
    relative_lift=DOUBLE,
    ci_low=DOUBLE,
    ci_high=DOUBLE,
    z_stat=DOUBLE,
    p_value=DOUBLE,
    significant=INT,
)

# Tables that grow run by run; who and when come from the run, never from the clock.
AUTHORED = {"created_at": MOMENT, "created_by": TEXT}
PREDICTION_ROWS = table(
    keys=("customer_id",),
    customer_id=LONG,
    category=TEXT,
    probability=DOUBLE,
    predicted=INT,
    label=INT,
    version_id=TEXT,
    **AUTHORED,
)
METRIC_ROWS = table(
    keys=("metric_id",),
    metric_id=TEXT,
    timestamp=MOMENT,
    version_id=TEXT,
    period_type=TEXT,
    period_start=DATE,
    period_end=DATE,
    accuracy=DOUBLE,
    precision=DOUBLE,
    recall=DOUBLE,
    f1=DOUBLE,
    auc=DOUBLE,
    n_predictions=LONG,
    n_high_risk=LONG,
    n_medium_risk=LONG,
    n_low_risk=LONG,
    avg_score=DOUBLE,
    median_score=DOUBLE,
    actual_default_rate=DOUBLE,
    predicted_default_rate=DOUBLE,
    **AUTHORED,
)
ALERT_ROWS = table(
    keys=("alert_id",),
    alert_id=TEXT,
    timestamp=MOMENT,
    alert_type=TEXT,
    severity=TEXT,
    metric_name=TEXT,
    current_value=DOUBLE,
    threshold_value=DOUBLE,
    deviation=DOUBLE,
    version=TEXT,
    period_start=DATE,
    period_end=DATE,
    message=TEXT,
    status=TEXT,
    resolved_at=MOMENT,
    resolved_by=TEXT,
    **AUTHORED,
)
VERSION_ROWS = table(
    keys=("version_id",),
    version_id=TEXT,
    version_number=INT,
    model=TEXT,
    variant=TEXT,
    trained_at=MOMENT,
    data_start=DATE,
    data_end=DATE,
    n_training=LONG,
    auc=DOUBLE,
    f1=DOUBLE,
    precision=DOUBLE,
    recall=DOUBLE,
    model_path=TEXT,
    status=TEXT,
    deployed_at=MOMENT,
    retired_at=MOMENT,
    notes=TEXT,
    **AUTHORED,
)


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """The columns of ``target``, cast; a column that ``df`` lacks is NULL, one that ``target`` lacks is an error."""
    extra = sorted(set(df.columns) - set(target.names))
    if extra:
        raise ValueError(f"columns not in the table: {extra}")
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )
