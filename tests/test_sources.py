from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks.inputs import Inputs
from martwright.plans.facts import fact_order_daily
from martwright.schemas import TABLES, UNKNOWN_MEMBERS, add_versioning, conform, empty_table, unknown_member
from martwright.session import materialize, shared_folder
from martwright.sources.ingest import SOURCE_TABLES, ingest
from martwright.sources.jdbc import Split, as_relation, scan_options, sink_options
from martwright.sources.parquet import (
    append_table,
    folder_name,
    read_table,
    read_version,
    replace_all_months,
    replace_months,
    write_table,
    write_version,
)
from martwright.streaming.incremental import load_batch, order_files, start_load


def test_shared_folder_is_under_the_checkpoint_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one != two and one.startswith(base)


def test_materialize_cuts_the_plan(spark):
    df = spark.range(10).withColumn("half", F.col("id") / 2)
    stored = materialize(df, "t")
    assert sorted(stored.collect()) == sorted(df.collect())
    assert "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()


def test_jdbc_options():
    split = Split("order_date", date(2024, 1, 1), date(2025, 1, 1), 32)
    got = scan_options("jdbc:x:y", "Sales.Orders", {"user": "u"}, split)
    assert got["dbtable"] == "Sales.Orders" and got["user"] == "u"
    assert (got["partitionColumn"], got["lowerBound"], got["numPartitions"]) == ("order_date", "2024-01-01", "32")
    assert as_relation("SELECT a FROM t WHERE b") == "(SELECT a FROM t WHERE b) src"
    assert as_relation("(SELECT 1) q") == "(SELECT 1) q"
    assert sink_options("u", "t", None, True, 8)["truncate"] == "true"
    assert "numPartitions" not in sink_options("u", "t", None, False, None)


def test_ingest_reports_failures_and_goes_on(spark):
    def read(table):
        if table == "Sales.Bad":
            raise ValueError("no such table " + "x" * 900)
        return spark.range(7)

    root = shared_folder(spark, "raw")
    at = datetime(2024, 1, 1, 12)
    report = ingest(spark, ["Sales.Good", "Sales.Bad", "Person.Other"], read, root, at).collect()
    assert [(r["table_name"], r["status"], r["row_count"]) for r in report] == [
        ("Sales.Good", "success", 7),
        ("Sales.Bad", "failed", 0),
        ("Person.Other", "success", 7),
    ]
    assert report[1]["error"] == "ValueError: no such table " + "x" * 900
    stored = spark.read.parquet(f"{root}/sales_good")
    assert {r["_ingested_at"] for r in stored.collect()} == {at}
    assert len(SOURCE_TABLES) == len({folder_name(t) for t in SOURCE_TABLES}) == 26


def test_versions(spark):
    root = shared_folder(spark, "gold")
    assert read_version(spark, root, "dim") is None
    assert write_version(spark.range(3), root, "dim") == 1
    old = read_version(spark, root, "dim")
    assert write_version(old.union(spark.range(5, 6)), root, "dim") == 2
    assert read_version(spark, root, "dim").count() == 4
    assert read_version(spark, root, "dim", 1).count() == 3


def test_failed_version_is_not_published(spark):
    root = shared_folder(spark, "gold")
    write_version(spark.range(3), root, "dim")
    with pytest.raises(Exception):
        write_version(spark.range(3).select(F.raise_error(F.lit("lost"))), root, "dim")
    assert read_version(spark, root, "dim").count() == 3


def test_write_and_append(spark):
    root = shared_folder(spark, "raw")
    write_table(spark.range(3), root, "A.B")
    write_table(spark.range(4), root, "A.B")
    append_table(spark.range(2), root, "A.B")
    assert read_table(spark, root, "A.B").count() == 6


def test_replace_months_leaves_other_months_alone(spark):
    root = shared_folder(spark, "gold")
    replace_months(spark.createDataFrame([(20240131, 1), (20240201, 1), (20240301, 1)], "date_key int, n int"), root, "f")
    replace_months(spark.createDataFrame([(20240210, 2)], "date_key int, n int"), root, "f")
    got = sorted((r["date_key"], r["n"]) for r in read_table(spark, root, "f").collect())
    assert got == [(20240131, 1), (20240210, 2), (20240301, 1)]


def test_emptied_months_leave(spark):
    root = shared_folder(spark, "gold")
    shape = "date_key int, n int"
    replace_months(spark.createDataFrame([(20240131, 1), (20240201, 1), (20240301, 1), (None, 5)], shape), root, "f")
    replace_months(spark.createDataFrame([(20240201, 2)], shape), root, "f", [202401, 202402, None, 202912])
    read = lambda: sorted((r["date_key"], r["n"]) for r in read_table(spark, root, "f", shape + ", month_key int").collect())
    assert read() == [(20240201, 2), (20240301, 1)]
    replace_all_months(spark.createDataFrame([(20240501, 9)], shape), root, "f")
    assert read() == [(20240501, 9)]


def test_two_writers_do_not_overwrite_each_other(spark, monkeypatch):
    from martwright.sources import parquet

    root = shared_folder(spark, "gold")
    write_version(spark.range(1), root, "dim")
    inner = parquet._versions
    monkeypatch.setattr(parquet, "_versions", lambda *a, **k: [])  # a writer that looked before the other wrote
    with pytest.raises(Exception, match="(?i)already.exists"):
        write_version(spark.range(2), root, "dim")
    monkeypatch.setattr(parquet, "_versions", inner)
    assert read_version(spark, root, "dim").count() == 1


def test_month_filter_prunes_partitions(spark):
    root = shared_folder(spark, "gold")
    replace_months(spark.createDataFrame([(20240131, 1), (20240201, 1)], "date_key int, n int"), root, "f")
    plan = read_table(spark, root, "f").filter("month_key = 202401")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_key" in plan


@pytest.mark.parametrize("table", TABLES)
def test_empty_tables_have_the_contract(spark, table):
    df = empty_table(spark, table)
    assert df.dtypes == list(TABLES[table].items()) and df.count() == 0
    assert conform(df, table).dtypes == df.dtypes


@pytest.mark.parametrize("table", UNKNOWN_MEMBERS)
def test_unknown_members_fit_their_table(spark, table):
    row = unknown_member(spark, table)
    assert row.dtypes == list(TABLES[table].items())
    assert row.first()[0] == "UNKNOWN"


def test_old_files_gain_columns(spark):
    old = spark.createDataFrame([("k", 1, "n")], "customer_key string, customer_id long, customer_name string")
    row = add_versioning(old, "dim_customer", date(2020, 1, 1)).first()
    assert (row["effective_date"], row["expiry_date"], row["is_current"], row["version"]) == (date(2020, 1, 1), None, True, 1)
    assert row["customer_type"] is None


def test_stream_equals_batch_and_picks_up_new_files(spark, folder):
    inputs = Inputs(spark, folder)
    header, detail = inputs.order_header, inputs.order_detail
    root = shared_folder(spark, "stream")
    early, late = F.col("order_date") < F.lit(date(1999, 6, 17)), F.col("order_date") >= F.lit(date(1999, 6, 17))
    header.filter(early).repartition(3).write.parquet(f"{root}/in")
    orders = order_files(spark, f"{root}/in", header.schema, files_per_batch=2)

    def load():
        start_load(orders, root, lambda: detail, "fact_order_daily", fact_order_daily).awaitTermination()
        return sorted(conform(read_table(spark, root, "fact_order_daily"), "fact_order_daily").collect())

    assert load() == sorted(fact_order_daily(header.filter(early), detail).collect())
    header.filter(late).coalesce(1).write.mode("append").parquet(f"{root}/in")
    full = sorted(fact_order_daily(header, detail).collect())
    assert load() == full
    # a batch that is replayed after a failure changes nothing
    last = header.filter(late)
    load_batch(last, 2, root, lambda: detail, "fact_order_daily", fact_order_daily)
    assert load() == full
