"""Every registered query against DuckDB, and the shape of its plan."""

import inspect

import pytest

from __spark_entry__ import entry
from checks import queries as registered
from checks.compare import compare, open_duckdb
from checks.oracle import ORACLE
from martwright.functions.labels import abc_class
from martwright.plans import analytics as a
from martwright.plans.clusters import customer_clusters
from pyspark.sql import functions as F

# no SQL can reproduce seeded clustering
ROWS_ONLY = {"x_kmeans_rfm"}


@pytest.fixture(scope="module")
def duck(folder):
    return open_duckdb(folder)


def test_every_query_has_sql():
    assert set(registered.QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(registered.QUERIES)


@pytest.mark.parametrize("name", registered.QUERIES)
def test_query_equals_duckdb(spark, duck, folder, name):
    verdict, _, _ = compare(spark, duck, registered.QUERIES[name], ORACLE.get(name), folder)
    assert verdict.startswith(("ok", "no SQL")), verdict


PURE = [
    n
    for n in registered.QUERIES
    if n.startswith(("fact_", "q_", "silver_", "dim_", "scd2_", "upsert", "full_", "incremental", "late", "affected"))
]


@pytest.mark.parametrize("name", PURE)
def test_plans_have_no_cross_join_and_no_global_window(spark, folder, name):
    plan = registered.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # position keys add up one number per range; nothing else may order a whole table in a window
    if name not in {"dim_vendor_positions"}:
        assert "SinglePartition" not in plan or "Window" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 10
    assert [r["total_revenue"] for r in rows] == sorted((r["total_revenue"] for r in rows), reverse=True)


def test_scan_reads_only_the_columns_it_needs(spark, folder):
    w = registered.Warehouse(spark, folder)
    plan = a.top_products(w.fact_product_daily, w.dim_product)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert any("product_key:string,quantity_sold:bigint,revenue" in s for s in scans)
    assert not any("gross_profit" in s for s in scans)


def test_incremental_filter_reaches_the_scan(spark, folder):
    from datetime import date

    from martwright.plans.incremental import orders_since

    header = registered.Warehouse(spark, folder).order_header
    plan = orders_since(header, date(2000, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_date,2000-01-01)" in plan


def test_totals_agree_across_facts(spark, folder):
    """The same lines stand behind every fact."""
    w = registered.Warehouse(spark, folder)
    lines = w.fact_order.agg(F.sum("line_total"), F.sum("order_qty")).first()
    daily = w.fact_product_daily.agg(F.sum("revenue"), F.sum("quantity_sold")).first()
    life = w.fact_customer_behavior.agg(F.sum("total_amount"), F.sum("total_quantity")).first()
    assert tuple(lines) == tuple(daily) == tuple(life)


@pytest.mark.parametrize(
    "dim, key", [("dim_product", "product_key"), ("dim_customer", "customer_key"), ("dim_seller", "seller_key"), ("dim_geography", "geography_key")]
)
def test_every_fact_key_resolves(spark, folder, dim, key):
    w = registered.Warehouse(spark, folder)
    assert w.fact_order.join(getattr(w, dim), key, "left_anti").count() == 0
    assert getattr(w, dim).groupBy(key).count().filter("count > 1").count() == 0


def test_reports_on_empty_facts(spark):
    from martwright.schemas import empty_table

    row = a.sales_kpis(empty_table(spark, "fact_product_daily"), empty_table(spark, "fact_order_daily")).first()
    assert [row[c] for c in ["total_revenue", "total_profit", "profit_margin", "total_orders"]] == [0, 0, 0, 0]
    assert a.rfm_scatter(empty_table(spark, "fact_customer_behavior")).count() == 0


def test_seller_name_is_a_value_not_sql(spark, folder):
    w = registered.Warehouse(spark, folder)
    odd = "x' OR '1'='1"
    assert a.seller_territories(w.fact_order_header, w.dim_seller, w.dim_geography, odd).count() == 0
    text = "SELECT count(*) AS n FROM {dim_seller} WHERE seller_name = :name"
    assert a.run_query(spark, text, {"dim_seller": w.dim_seller}, {"name": odd}).first()["n"] == 0


def test_clusters_repeat_and_cover_everyone(spark, folder):
    w = registered.Warehouse(spark, folder)
    one, two = (
        {r["fact_customer_behavior_key"]: r["cluster"] for r in customer_clusters(w.fact_customer_behavior, k=3).collect()}
        for _ in range(2)
    )
    assert one == two and len(one) == w.fact_customer_behavior.count() and set(one.values()) == {0, 1, 2}


def test_order_reports_do_not_touch_lines(spark, folder):
    w = registered.Warehouse(spark, folder)
    reports = {
        "kpis": a.sales_kpis(w.fact_product_daily, w.fact_order_daily),
        "types": a.order_value_by_type(w.fact_order_header, w.dim_customer),
        "countries": a.revenue_by_country(w.fact_order_header, w.dim_geography),
        "regions": a.top_regions(w.fact_order_header, w.dim_geography, w.dim_customer),
    }
    for name, df in reports.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "line_total" not in plan and "fact_order_key" not in plan and "order_id" not in plan, name


def test_category_report_shuffles_names_only(spark, folder):
    w = registered.Warehouse(spark, folder)
    plan = a.category_by_country(w.fact_order, w.dim_product, w.dim_geography)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(country_name" in plan
    for line in plan.splitlines():
        if "HashAggregate(keys=" in line:
            assert "geography_key" not in line and "product_key" not in line


def test_clusters_with_missing_measures(spark, folder):
    w = registered.Warehouse(spark, folder)
    some = w.fact_customer_behavior.withColumn("recency_days", F.expr("CASE WHEN total_orders % 5 = 0 THEN NULL ELSE recency_days END"))
    found = customer_clusters(some, k=3)
    assert found.filter("recency_days IS NULL AND cluster IS NOT NULL").count() == 0
    assert found.filter("recency_days IS NOT NULL AND cluster IS NULL").count() == 0
    assert found.count() == some.count()
    assert customer_clusters(some.withColumn("total_amount", F.lit(None).cast("decimal(28,4)"))).filter("cluster IS NULL").count() == some.count()


def test_abc_limits(spark):
    df = spark.createDataFrame([(80, "A"), (81, "B"), (95, "B"), (96, "C"), (100, "C")], "r int, c string")
    assert df.filter(abc_class(F.col("r"), F.lit(100)) != F.col("c")).count() == 0


def test_queries_take_whole_tables():
    """No sampling, row caps or modulo filters in the registered queries."""
    source = inspect.getsource(registered)
    for word in [".sample(", ".limit(", "LIMIT", ".head(", ".take("]:
        assert word not in source
