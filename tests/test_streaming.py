import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.session import workspace
from duebook.operators import learning, masking, monitoring
from duebook.sources import schemas, sinks
from duebook.sources.documents import read_documents
from duebook.sources.widening import WideningTable, read_merged
from duebook.streaming import chunks, ingest, metrics, scoring

DROP = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.DoubleType())])


def write_text(spark, path, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_ingest_takes_new_files_once_and_keeps_bad_lines(spark):
    root = workspace(spark, "test")
    write_text(spark, f"{root}/drops", ["id,amount", "1,2.5", "2,oops"])
    for _ in range(2):
        ingest.append_available(ingest.csv_stream(spark, f"{root}/drops", DROP), f"{root}/out", f"{root}/cp")
    rows = {r["id"]: (r["amount"], r[ingest.CORRUPT]) for r in spark.read.parquet(f"{root}/out").collect()}
    assert rows == {1: (2.5, None), 2: (None, "2,oops")}
    write_text(spark, f"{root}/drops", ["id,amount", "3,1.0"])
    ingest.append_available(ingest.csv_stream(spark, f"{root}/drops", DROP), f"{root}/out", f"{root}/cp")
    assert spark.read.parquet(f"{root}/out").count() == 3


def test_closed_days_equal_the_batch_result_and_late_rows_are_dropped(spark):
    root = workspace(spark, "test")
    day = dt.datetime(2024, 1, 1)

    def drop(*rows):
        df = spark.createDataFrame(rows, "ts timestamp, event_type string, value double")
        df.coalesce(1).write.mode("append").parquet(f"{root}/events")

    def run():
        schema = "ts timestamp, event_type string, value double"
        stream = spark.readStream.schema(schema).parquet(f"{root}/events")
        ingest.append_available(metrics.daily_metrics(stream), f"{root}/daily", f"{root}/cp")
        return {(r["day"], r["n_events"], r["n_errors"]) for r in spark.read.parquet(f"{root}/daily").collect()}

    drop((day, "error", 1.0), (day + dt.timedelta(hours=5), "error", 2.0), (day + dt.timedelta(days=1, hours=3), "error", 4.0))
    first = (day.date(), 2, 2)
    assert run() == {first}
    drop((day + dt.timedelta(hours=1), "error", 9.0), (day + dt.timedelta(days=2, hours=1), "error", 1.0))
    assert run() == {first, ((day + dt.timedelta(days=1)).date(), 1, 1)}


def test_open_days_are_shown_and_replaced_by_later_totals(spark):
    root = workspace(spark, "test")
    day = dt.datetime(2024, 3, 1)
    schema = "ts timestamp, event_type string, value double"

    def run(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/events")
        stream = spark.readStream.schema(schema).parquet(f"{root}/events")
        metrics.upsert_daily_metrics(stream, f"{root}/daily", f"{root}/cp")
        current = metrics.current_daily_metrics(spark, f"{root}/daily").collect()
        return {(r["day"].day, r["event_type"], r["n_events"], r["total_value"]) for r in current}

    assert run((day, "click", 1.0), (day + dt.timedelta(days=1), "click", 2.0)) == {(1, "click", 1, 1.0), (2, "click", 1, 2.0)}
    later = run((day + dt.timedelta(days=1, hours=1), "click", 3.0), (day + dt.timedelta(days=1, hours=2), "error", 4.0))
    assert later == {(1, "click", 1, 1.0), (2, "click", 2, 5.0), (2, "error", 1, 4.0)}


def test_a_new_version_replaces_all_chunks_of_a_document(spark):
    root = workspace(spark, "test")
    schema = "doc_id bigint, text string, lang string, source string, version int"

    def send(*rows):
        df = spark.createDataFrame(rows, schema)
        df.coalesce(1).write.mode("append").parquet(f"{root}/feed")
        chunks.sync_chunks(spark, f"{root}/feed", df.schema, f"{root}/out", f"{root}/cp")
        return sorted((r["doc_id"], r["version"], r["chunk_index"]) for r in chunks.current_chunks(spark, f"{root}/out").collect())

    long = " ".join(["w"] * 500)
    assert send((1, long, "en", "s", 1), (2, "a", "en", "s", 1)) == [(1, 1, 0), (1, 1, 1), (1, 1, 2), (2, 1, 0)]
    assert send((1, "short now", "en", "s", 2)) == [(1, 2, 0), (2, 1, 0)]
    assert send((1, "short now", "en", "s", 2)) == [(1, 2, 0), (2, 1, 0)]  # sent again: still once
    for _ in range(2):  # nothing to do the second time
        chunks.compact(spark, f"{root}/out")
        current = chunks.current_chunks(spark, f"{root}/out")
        assert current.count() == 2 and all("/bases/upto=2/" in path for path in current.inputFiles())
    assert send((2, "", "en", "s", 2)) == [(1, 2, 0)]  # emptied: its chunks are gone
    chunks.compact(spark, f"{root}/out")
    assert send((2, "back", "en", "s", 3)) == [(1, 2, 0), (2, 3, 0)]
    folders = {path.split(f"{root}/out/")[1].rsplit("/", 1)[0] for path in chunks.current_chunks(spark, f"{root}/out").inputFiles()}
    assert folders == {"bases/upto=3/chunks", "bases/upto=3/versions", "chunks/batch_id=4", "versions/batch_id=4"}


def test_a_clustered_table_prunes_by_file_statistics(spark):
    root = workspace(spark, "test")
    rows = spark.range(20_000).selectExpr("id % 997 AS customer_id", "id AS invoice_id")
    sinks.write_clustered(rows, root, ["customer_id", "invoice_id"], files=16)
    ranges = []
    for path in spark.read.parquet(root).inputFiles():
        footer = pq.ParquetFile(path.removeprefix("file://")).metadata
        stats = [footer.row_group(i).column(0).statistics for i in range(footer.num_row_groups)]
        ranges.append((min(s.min for s in stats), max(s.max for s in stats)))
    assert len(ranges) == 16
    assert sum(low <= 120 and high >= 100 for low, high in ranges) <= 2


def test_an_overwrite_replaces_the_schema(spark):
    root = workspace(spark, "test")
    sinks.overwrite(spark.createDataFrame([(1, "a")], "id int, name string"), root)
    sinks.overwrite(spark.createDataFrame([(2.5,)], "amount double"), root)
    assert spark.read.parquet(root).collect() == [Row(amount=2.5)]


def test_a_table_widens_by_load(spark):
    table = WideningTable(spark, workspace(spark, "test"))
    assert table.schema() is None and table.read().count() == 0
    table.append("1", spark.createDataFrame([(1, 1.5)], "id int, amount float"))
    for _ in range(2):
        table.append("2", spark.createDataFrame([(1 << 40, "x")], "id long, Note string"))
    table.append("3", spark.createDataFrame([(2, "y", 0.1)], "id short, note string, amount double"))
    rows = sorted(table.read().collect(), key=lambda r: r.load_id)
    assert [tuple(r) for r in rows] == [(1, 1.5, None, "1"), (1 << 40, None, "x", "2"), (2, 0.1, "y", "3")]
    for wrong in ("id string", "load_id string", "a int, A int"):
        with pytest.raises(ValueError):
            table.append("4", spark.createDataFrame([], wrong))
    assert table.read().count() == 3


def test_stored_and_merged_schemas_agree(spark):
    table = WideningTable(spark, workspace(spark, "test"))
    table.append("a", spark.createDataFrame([(1,)], "id int"))
    table.append("b", spark.createDataFrame([(2, "n")], "id int, note string"))
    merged = read_merged(spark, f"{table.root}/loads")
    assert sorted(map(tuple, merged.select("id", "note", "load_id").collect())) == sorted(map(tuple, table.read().collect()))


def test_masks_default_to_hidden(spark):
    rows = spark.createDataFrame(
        [("a", 1, "n1", 5), ("b", 1, "n1", 5), (None, 1, "n1", 5), ("c", 1, None, 5)], "role string, id int, name string, n int"
    )
    rules = [("a", "name", "show"), ("a", "name", "digits"), ("a", "n", "digits"), ("b", "n", "show"), ("b", "name", "odd"), ("c", "name", "digits"), (None, "n", "show")]
    seen = masking.masked(rows, spark.createDataFrame(rules, masking.POLICY), ["id"]).collect()
    assert sorted(map(tuple, seen), key=str) == sorted([("a", 1, "n*", None), ("b", 1, None, 5), (None, 1, None, None), ("c", 1, None, None)], key=str)
    assert masking.masked(rows, spark.createDataFrame([], masking.POLICY)).select("name").distinct().collect() == [Row(name=None)]


def test_partition_overwrite_touches_only_its_partitions(spark):
    root = workspace(spark, "test")
    first = spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "id int, m string")
    sinks.overwrite_partitions(first, root, "m")
    sinks.overwrite_partitions(spark.createDataFrame([(3, "2024-02")], "id int, m string"), root, "m")
    back = spark.read.schema(sinks.written_schema(first, "m")).parquet(root)
    assert sorted(map(tuple, back.collect())) == [(1, "2024-01"), (3, "2024-02")]
    plan = back.filter("m = '2024-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan


def test_log_append_and_freshness(spark):
    root = workspace(spark, "test")
    for run in (1, 2):
        sinks.append_log(spark.createDataFrame([(run,)], "run int"), root)
    log = spark.read.parquet(root)
    assert log.count() == 2
    assert sinks.freshness(log, "log").first()["last_update"] is not None
    assert sinks.health(log.filter(F.lit(False)), "log").first()["status"] == "EMPTY"


def test_log_rows_are_cast_to_the_table(spark):
    root = workspace(spark, "test")
    row = spark.createDataFrame([(1, 2.0, "OK")], "n_drifted int, drift_pct double, status string")
    sinks.append_log(row, root, schemas.MONITORING)
    assert spark.read.parquet(root).schema.names == schemas.MONITORING.names
    with pytest.raises(ValueError):
        schemas.conform(row.withColumn("other", F.lit(1)), schemas.MONITORING)
    assert list(monitoring.log_columns()) == schemas.METRIC_LOG.names


def test_documents_are_read_whole(spark):
    root = workspace(spark, "test")
    text = "first line\nsecond line"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(root)
    rows = read_documents(spark, root).collect()
    assert [r["text"].strip() for r in rows if r["text"].strip()] == [text]
    assert rows[0]["path"].endswith(rows[0]["name"] + ".txt")


def test_saved_model_scores_a_stream_by_key(spark):
    root = workspace(spark, "test")
    rows = [(i, i % 2, float(i % 2), "A", "SMALL") for i in range(60)]
    cases = spark.createDataFrame(rows, "customer_id int, label int, a double, sector string, size_band string")
    learning.fit_default_model(cases, ["a"]).write().save(f"{root}/model")
    model = PipelineModel.load(f"{root}/model")
    requests = cases.drop("label")
    requests.write.parquet(f"{root}/requests")

    def score(df):
        return learning.score_default(model, df).select("customer_id", "score", "predicted")

    scoring.score_requests(spark, f"{root}/requests", requests.schema, score, f"{root}/out", f"{root}/cp")
    got = {r["customer_id"]: r["predicted"] for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {i: i % 2 for i in range(60)}
