"""Shared views of the check SQL, resolved into one WITH clause."""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, text: str, *needs: str) -> None:
    VIEWS[name] = (needs, text.strip())


def with_views(body: str, *names: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for need in VIEWS[name][0]:
            visit(need)
        ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return body.strip()
    parts = ",\n".join(f"{name} AS (\n{VIEWS[name][1]}\n)" for name in ordered)
    return f"WITH {parts}\n{body.strip()}"


view("params", "SELECT max(CAST(o_orderdate AS DATE)) AS as_of FROM orders")

view(
    "customers",
    """
SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS sector,
  CASE WHEN c_acctbal < 3000 THEN 'SMALL' WHEN c_acctbal < 7000 THEN 'MEDIUM' ELSE 'LARGE' END AS size_band,
  n_name AS nation
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""",
)

view(
    "invoices",
    """
SELECT o_orderkey AS invoice_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
  CAST(o_orderdate AS DATE) AS issue_date,
  CAST(o_orderdate AS DATE) + CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 30
    WHEN o_orderpriority = '3-MEDIUM' THEN 60 ELSE 90 END AS due_date,
  CASE o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'PENDING' ELSE 'OVERDUE' END AS status,
  strftime(o_orderdate, '%Y-%m') AS issue_month
FROM orders
""",
)

view(
    "payments",
    """
SELECT l_orderkey AS invoice_id, l_linenumber AS line_no, l_partkey AS part_id, l_suppkey AS supplier_id,
  CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS amount,
  CAST(l_shipdate AS DATE) AS payment_date, l_returnflag AS method
FROM lineitem
""",
)

view(
    "paid",
    """
SELECT invoice_id, CAST(sum(amount) AS DECIMAL(18,4)) AS paid_total, count(*) AS n_payments,
  min_by(method, (payment_date, line_no, part_id, supplier_id)) AS method,
  max(payment_date) AS last_payment
FROM payments GROUP BY invoice_id
""",
    "payments",
)

view(
    "silver",
    """
SELECT i.invoice_id, i.customer_id, i.amount AS total_amount, i.issue_date, i.due_date, i.status, i.issue_month,
  coalesce(p.paid_total, 0) AS paid_total, p.method, CAST(i.status = 'PAID' AS INTEGER) AS paid_flag,
  CAST(CASE WHEN i.status = 'PAID' THEN 0 ELSE i.amount - coalesce(p.paid_total, 0) END AS DECIMAL(18,4)) AS open_amount,
  CAST(CASE WHEN i.status = 'OVERDUE'
    THEN greatest(date_diff('day', i.due_date, coalesce(p.last_payment, params.as_of)), 1) ELSE 0 END AS INTEGER) AS days_late
FROM invoices i LEFT JOIN paid p ON p.invoice_id = i.invoice_id, params
WHERE i.amount >= 0
""",
    "params",
    "invoices",
    "paid",
)

view(
    "invoice_features",
    """
SELECT customer_id,
  CAST(sum(CASE WHEN date_diff('day', issue_date, as_of) <= 90 THEN total_amount ELSE 0 END) AS DOUBLE) AS billed_90d,
  CAST(sum(CASE WHEN date_diff('day', issue_date, as_of) <= 180 THEN total_amount ELSE 0 END) AS DOUBLE) AS billed_180d,
  CAST(sum(CASE WHEN date_diff('day', issue_date, as_of) <= 365 THEN total_amount ELSE 0 END) AS DOUBLE) AS billed_365d,
  count(*) AS n_invoices,
  CAST(sum(CASE WHEN status = 'PAID' THEN 1 ELSE 0 END) AS BIGINT) AS n_paid,
  CAST(sum(CASE WHEN status = 'PENDING' THEN 1 ELSE 0 END) AS BIGINT) AS n_pending,
  CAST(sum(CASE WHEN status = 'OVERDUE' THEN 1 ELSE 0 END) AS BIGINT) AS n_overdue,
  CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_amount,
  round(coalesce(stddev_samp(CAST(total_amount AS DOUBLE)), 0), 4) AS sd_amount,
  CAST(min(total_amount) AS DOUBLE) AS min_amount,
  CAST(max(total_amount) AS DOUBLE) AS max_amount,
  CAST(date_diff('day', max(issue_date), max(as_of)) AS INTEGER) AS recency_days
FROM silver, params WHERE issue_date <= as_of GROUP BY customer_id
""",
    "silver",
    "params",
)

view(
    "features",
    """
SELECT c.customer_id, c.name, c.sector, c.size_band, c.nation,
  coalesce(billed_90d, 0) AS billed_90d, coalesce(billed_180d, 0) AS billed_180d,
  coalesce(billed_365d, 0) AS billed_365d, coalesce(n_invoices, 0) AS n_invoices, coalesce(n_paid, 0) AS n_paid,
  coalesce(n_pending, 0) AS n_pending, coalesce(n_overdue, 0) AS n_overdue,
  coalesce(avg_amount, 0) AS avg_amount, coalesce(sd_amount, 0) AS sd_amount,
  coalesce(min_amount, 0) AS min_amount, coalesce(max_amount, 0) AS max_amount,
  coalesce(round(CAST(n_paid AS DOUBLE) / n_invoices * 100, 2), 0) AS pay_rate,
  coalesce(round(CAST(n_overdue AS DOUBLE) / n_invoices * 100, 2), 0) AS overdue_rate,
  recency_days
FROM customers c LEFT JOIN invoice_features f ON f.customer_id = c.customer_id
""",
    "customers",
    "invoice_features",
)

view(
    "rfm",
    """
SELECT *, CASE WHEN recency_score >= 4 THEN 'Premium' WHEN recency_score = 3 THEN 'Regular' ELSE 'At risk' END AS category
FROM (SELECT *, CASE WHEN recency_days < 30 THEN 5 WHEN recency_days < 60 THEN 4 WHEN recency_days < 90 THEN 3
  WHEN recency_days < 180 THEN 2 ELSE 1 END AS recency_score FROM features)
""",
    "features",
)
