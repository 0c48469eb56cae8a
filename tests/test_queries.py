"""Every query with SQL gives the rows of that SQL; the plans and the package keep their promises."""

import pathlib
import re

import duckdb
import pytest

import __spark_entry__ as entry

PACKAGE = pathlib.Path(entry.__file__).parent / "duebook"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()  # fmt: skip
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def canonical(rows):
    return sorted(tuple(repr(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(name, spark, duck, folder):
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = [tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()]
    assert canonical(got) == canonical(want)


FITTED = "kmeans_profiles kmeans_quality kmeans_profile_stats gbt_default_scores gbt_default_metrics feature_importance gbt_value_at_risk"


@pytest.mark.parametrize("name", ["knn_cell_recall", "knn_lsh_recall", *FITTED.split()])
def test_query_without_sql_runs(name, spark, folder):
    rows = QUERIES[name](spark, folder).collect()
    assert rows
    if name == "knn_lsh_recall":
        assert sum(r["n_found"] for r in rows) >= 0.5 * sum(r["n_exact"] for r in rows)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["silver_invoices", "customer_features", "score_customers", "scorecard"])
def test_row_level_plans_use_no_single_partition(name, spark, folder):
    assert "SinglePartition" not in plan_of(QUERIES[name](spark, folder))


def test_scans_read_only_what_they_need(spark, folder):
    plan = plan_of(QUERIES["customer_features"](spark, folder))
    assert "lineitem" not in plan
    schema = re.findall(r"ReadSchema: struct<([^>]*o_orderstatus[^>]*)>", plan)
    assert schema and "o_orderpriority" not in schema[0] and "o_orderkey" not in schema[0]


def test_chunking_splits_a_text_once(spark, folder):
    plan = QUERIES["doc_chunks"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_package_never_pulls_tables_to_the_driver():
    banned = re.compile(r"\.toPandas\(|\.collect\(\)|localCheckpoint|crossJoin|\.rdd\b")
    for path in PACKAGE.rglob("*.py"):
        assert not banned.search(path.read_text()), path
