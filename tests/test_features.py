import datetime as dt

from pyspark.sql import functions as F

from duebook.operators import features, silver
from duebook.operators.ranking import prioritise
from duebook.functions.bands import right_closed

AS_OF = dt.date(2024, 6, 1)


def days_ago(n):
    return AS_OF - dt.timedelta(days=n)


def test_recency_uses_the_newest_invoice(spark):
    rows = [(5, days_ago(63)), (5, days_ago(17)), (5, days_ago(364)), (9, days_ago(0)), (11, days_ago(121))]
    df = spark.createDataFrame(rows, "customer_id int, issue_date date")
    assert {r[0]: r[1] for r in features.recency(df, AS_OF).collect()} == {5: 17, 9: 0, 11: 121}


def test_recency_score_bounds(spark):
    days = [0, 29, 30, 59, 60, 89, 90, 179, 180, 400, None]
    df = spark.createDataFrame([(d,) for d in days], "recency_days int")
    scores = {r["recency_days"]: r["recency_score"] for r in features.add_recency_score(df).collect()}
    assert [scores[d] for d in days] == [5, 5, 4, 4, 3, 3, 2, 2, 1, 1, 1]


def test_recency_category(spark):
    df = spark.createDataFrame([(2,), (58,), (88,), (97,)], "recency_days int")
    got = [r["category"] for r in features.add_recency_score(df).orderBy("recency_days").collect()]
    assert got == ["Premium", "Premium", "Regular", "At risk"]


def ledger_rows(spark):
    invoices = spark.createDataFrame(
        [
            (1, 7, 100.0, days_ago(50), days_ago(20), "OVERDUE"),
            (2, 7, 50.0, days_ago(100), days_ago(70), "PAID"),
            (3, 7, 80.0, days_ago(200), days_ago(170), "PENDING"),
            (4, 8, 10.0, days_ago(10), days_ago(-20), "OVERDUE"),
            (5, 8, -5.0, days_ago(10), days_ago(0), "PAID"),
        ],
        "invoice_id bigint, customer_id bigint, amount double, issue_date date, due_date date, status string",
    ).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    payments = spark.createDataFrame(
        [
            (1, 2, 1, 1, 30.0, days_ago(5), "N"),
            (1, 1, 1, 1, 10.0, days_ago(15), "A"),
            (3, 1, 1, 1, 100.0, days_ago(1), "R"),
            (9, 1, 1, 1, 1.0, days_ago(1), "R"),
        ],
        "invoice_id bigint, line_no int, part_id bigint, supplier_id bigint, amount double, payment_date date, method string",
    ).withColumn("amount", F.col("amount").cast("decimal(18,4)"))
    return invoices, payments


def test_enriched_invoices(spark):
    invoices, payments = ledger_rows(spark)
    rows = {r["invoice_id"]: r for r in silver.enrich_invoices(invoices, payments, AS_OF).collect()}
    assert set(rows) == {1, 2, 3, 4}
    assert (float(rows[1]["paid_total"]), float(rows[1]["open_amount"]), rows[1]["method"]) == (40.0, 60.0, "A")
    assert rows[1]["days_late"] == 15
    assert (float(rows[2]["open_amount"]), rows[2]["paid_flag"], rows[2]["method"]) == (0.0, 1, None)
    assert float(rows[3]["open_amount"]) == -20.0
    assert rows[4]["days_late"] == 1


def test_customer_features_edges(spark):
    invoices, payments = ledger_rows(spark)
    enriched = silver.enrich_invoices(invoices, payments, AS_OF)
    customers = spark.createDataFrame([(7, "a"), (8, "b"), (9, "c")], "customer_id bigint, name string")
    rows = {r["customer_id"]: r for r in features.customer_features(customers, enriched, AS_OF).collect()}
    assert (rows[7]["billed_90d"], rows[7]["billed_180d"], rows[7]["billed_365d"]) == (100.0, 150.0, 230.0)
    assert (rows[7]["pay_rate"], rows[7]["overdue_rate"], rows[7]["n_invoices"]) == (33.33, 33.33, 3)
    assert rows[8]["sd_amount"] == 0.0
    assert (rows[9]["n_invoices"], rows[9]["overdue_rate"], rows[9]["recency_days"]) == (0, 0.0, None)


def test_point_in_time_features_ignore_later_invoices(spark):
    invoices, payments = ledger_rows(spark)
    enriched = silver.enrich_invoices(invoices, payments, AS_OF)
    early = features.invoice_features(enriched, days_ago(150)).collect()
    assert [(r["customer_id"], r["n_invoices"]) for r in early] == [(7, 1)]


def test_newest_per_key_keeps_one_row_and_drops_null_keys(spark):
    df = spark.createDataFrame([(1, " a ", 1), (1, " b", 2), (None, "c", 3), (2, "d", 1)], "customer_id int, name string, load_no int")
    got = sorted(map(tuple, silver.clean_customers(df, ["load_no"]).select("customer_id", "name", "load_no").collect()))
    assert got == [(1, "b", 2), (2, "d", 1)]


def test_negative_exposure_never_raises_priority(spark):
    scores = spark.createDataFrame([(1, 0.9), (2, 0.5)], "customer_id int, probability double")
    values = spark.createDataFrame([(1, -100.0, "None"), (2, 50000.0, "High")], "customer_id int, predicted_value double, money_band string")
    got = {r["customer_id"]: (r["priority_score"], r["priority"]) for r in prioritise(scores, values).collect()}
    assert got == {1: (0.0, "Low"), 2: (25000.0, "Critical")}


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (5000.0,), (5000.01,), (None,)], "v double")
    inf = float("inf")
    bands = right_closed(F.col("v"), (-inf, 0, 5000, inf), ("a", "b", "c"))
    assert [r[0] for r in df.select(bands).collect()] == ["a", "a", "b", "c", None]


def test_quintiles_of_customers_without_invoices(spark):
    rows = [(i, i if i else None, i, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "customer_id int, recency_days int, n_invoices int, billed_365d double")
    got = {r["customer_id"]: (r["r_quintile"], r["f_quintile"]) for r in features.rfm_quintiles(df).collect()}
    assert got[0] == (1, 1) and got[1] == (5, 1) and got[9] == (1, 5)


def test_ledger_frames_have_the_declared_types(spark, folder):
    from duebook.sources import schemas
    from duebook.sources.ledger import Ledger

    book = Ledger(spark, folder)
    for df, target in ((book.customers(), schemas.CUSTOMERS), (book.invoices(), schemas.INVOICES), (book.payments(), schemas.PAYMENTS)):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in target]
