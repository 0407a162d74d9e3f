import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks.inputs import AS_OF, Inputs
from checks.queries import _silver_of
from martwright.plans.facts import fact_order_daily, fact_product_daily
from martwright.plans.refresh import add_facts, load_dimensions, load_facts, load_increment, load_warehouse
from martwright.schemas import conform
from martwright.session import WIDTH, fitted_shuffles, shared_folder
from martwright.sources.parquet import read_table, read_version, replace_months


@pytest.fixture(scope="module")
def silver(spark, folder):
    return _silver_of(Inputs(spark, folder))


CALENDAR = (date(1995, 1, 1), date(2001, 12, 31))


def test_second_load_of_the_same_data_changes_nothing(spark, silver):
    root = shared_folder(spark, "gold")
    first = load_warehouse(silver, root, date(2001, 9, 1), AS_OF, CALENDAR).collect()
    stored = sorted(read_version(spark, root, "dim_product").collect())
    again = load_warehouse(silver, root, date(2001, 10, 1), AS_OF, CALENDAR).collect()
    assert sorted(first) == sorted(again)
    assert sorted(read_version(spark, root, "dim_product").collect()) == stored
    direct = fact_product_daily(
        silver["sales_order_header"], silver["sales_order_detail"], read_version(spark, root, "dim_product")
    )
    from_lines = conform(read_table(spark, root, "fact_product_daily"), "fact_product_daily")
    assert sorted(from_lines.collect()) == sorted(direct.collect())


def test_price_change_keeps_old_orders_on_the_old_version(spark, silver):
    root = shared_folder(spark, "gold")
    load_warehouse(silver, root, date(1998, 7, 1), AS_OF, CALENDAR)
    before = read_table(spark, root, "fact_order").select("fact_order_key", "date_key", "product_key")
    before = {r[0]: (r[1], r[2]) for r in before.collect()}
    dearer = silver | {"product": silver["product"].withColumn("list_price", F.col("list_price") + 1)}
    load_warehouse(dearer, root, date(1998, 7, 1), AS_OF, CALENDAR, full=True)
    after = {r["fact_order_key"]: r["product_key"] for r in read_table(spark, root, "fact_order").collect()}
    assert set(after) == set(before)
    for line, (day, key) in before.items():
        if key != "UNKNOWN":
            assert (after[line] != key) == (day >= 19980701)


def test_increment_skips_when_nothing_is_new(spark, silver):
    root = shared_folder(spark, "gold")
    header, detail = silver["sales_order_header"], silver["sales_order_detail"]
    early = header.filter(F.col("order_date") < F.lit(date(1999, 3, 3)))
    assert load_increment(early, detail, root, "fact_order_daily", fact_order_daily)
    assert not load_increment(early.filter("false"), detail, root, "fact_order_daily", fact_order_daily)
    assert load_increment(header, detail, root, "fact_order_daily", fact_order_daily)
    got = conform(read_table(spark, root, "fact_order_daily"), "fact_order_daily")
    assert sorted(got.collect()) == sorted(fact_order_daily(header, detail).collect())
    state = read_version(spark, root, "load_state").collect()
    assert [(r["table_name"], r["last_loaded"].date()) for r in state] == [("fact_order_daily", date(2001, 8, 1))]


def test_looking_back_never_moves_the_mark_back(spark, silver):
    root = shared_folder(spark, "gold")
    header, detail = silver["sales_order_header"], silver["sales_order_detail"]
    build = fact_order_daily
    assert load_increment(header, detail, root, "fact_order_daily", build)
    older = header.filter(F.col("order_date") < F.lit(date(2001, 7, 25)))
    assert load_increment(older, detail, root, "fact_order_daily", build, lateness_days=30)
    mark = read_version(spark, root, "load_state").first()["last_loaded"]
    assert mark.date() == date(2001, 8, 1)


def test_facts_without_orders_are_skipped(spark, silver):
    nothing = silver | {"sales_order_header": silver["sales_order_header"].filter("order_id < 0")}
    rows = load_warehouse(nothing, shared_folder(spark, "gold"), date(2001, 9, 1), AS_OF, CALENDAR).collect()
    skipped = {r["table_name"] for r in rows if r["status"] == "skipped"}
    assert skipped == {
        "fact_order",
        "fact_order_header",
        "fact_product_daily",
        "fact_seller_daily",
        "fact_order_daily",
        "fact_customer_behavior",
    }


def test_shuffle_width_follows_the_input_and_comes_back(spark, folder):
    lines = Inputs(spark, folder).lineitem
    old = spark.conf.get(WIDTH, None)
    with fitted_shuffles(lines) as width:
        assert width == int(spark.conf.get("spark.sql.shuffle.partitions"))
    with fitted_shuffles(lines, bytes_per_partition=1000) as width:
        assert width > 100 and spark.conf.get(WIDTH) == str(width)
    assert spark.conf.get(WIDTH, None) == old


def test_shuffle_width_of_joins_follows_their_scans(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    scans = sum(os.path.getsize(f"{folder}/{t}.parquet") for t in ("orders", "lineitem"))
    chain = lines.withColumnRenamed("l_orderkey", "o_orderkey").join(orders, "o_orderkey").join(orders.select("o_orderkey"), "o_orderkey")
    unsized = spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "o_orderkey long").join(orders, "o_orderkey")
    small = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with fitted_shuffles(chain, unsized, bytes_per_partition=scans) as width:
        assert width <= small + 3
    with fitted_shuffles(chain, bytes_per_partition=scans // 100) as width:
        assert 100 <= width <= 300


def test_loads_set_the_shuffle_width(spark, silver, monkeypatch):
    from martwright.plans import refresh

    seen = []
    inner = refresh.fitted_shuffles
    monkeypatch.setattr(refresh, "fitted_shuffles", lambda *a, **k: seen.append(len(a)) or inner(*a, bytes_per_partition=1000))
    root = shared_folder(spark, "gold")
    header, detail = silver["sales_order_header"], silver["sales_order_detail"]
    few = header.filter("order_id < 400")
    load_increment(few, detail, root, "fact_order_daily", fact_order_daily)
    load_warehouse(silver | {"sales_order_header": few}, shared_folder(spark, "gold"), date(2001, 9, 1), AS_OF)
    assert seen == [2, 2] and spark.conf.get(WIDTH, None) is None


def test_orders_outside_the_calendar_and_without_a_date(spark, silver):
    """The calendar follows the orders; an order without a date is kept, by the first load and by increments."""
    header = silver["sales_order_header"].filter("order_id < 400")
    odd = header.withColumn("order_date", F.expr("CASE WHEN order_id % 3 = 0 THEN DATE '2009-05-06' WHEN order_id % 7 = 1 THEN NULL ELSE order_date END"))
    root = shared_folder(spark, "gold")
    load_warehouse(silver | {"sales_order_header": odd}, root, date(2001, 9, 1), AS_OF, (date(2010, 1, 1), date(2030, 12, 31)))
    days = read_version(spark, root, "dim_date")
    facts = conform(read_table(spark, root, "fact_product_daily"), "fact_product_daily")
    assert facts.filter("date_key IS NOT NULL").join(days, "date_key", "left_anti").count() == 0
    from martwright.plans.analytics import daily_trend

    trend = daily_trend(facts, days).collect()
    assert sum(r["revenue"] for r in trend) == facts.agg(F.sum("revenue")).first()[0]
    with pytest.raises(Exception, match="outside the calendar"):
        daily_trend(facts, days.filter("year <> 2009")).collect()
    detail, two = silver["sales_order_detail"], shared_folder(spark, "gold")
    for known in (odd.filter("order_id < 200"), odd):
        load_increment(known, detail, two, "fact_order_daily", fact_order_daily, lateness_days=100_000)
    got = conform(read_table(spark, two, "fact_order_daily"), "fact_order_daily")
    assert sorted(got.collect(), key=str) == sorted(fact_order_daily(odd, detail).collect(), key=str)


def test_increment_reads_only_the_months_of_the_batch(spark, silver):
    """Lines are pruned by stored month and joined to the batch's orders before anything is added up."""
    from martwright.plans.incremental import lines_with_month, rebuild_months, with_month
    from martwright.sources.parquet import replace_all_months

    root = shared_folder(spark, "silver")
    header = with_month(silver["sales_order_header"])
    replace_all_months(header, root, "orders")
    replace_all_months(lines_with_month(header, silver["sales_order_detail"]), root, "lines")
    orders, lines = (read_table(spark, root, t) for t in ("orders", "lines"))
    fresh = rebuild_months(orders, lines, [199903, 199904], fact_order_daily)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "PartitionFilters" in x]
    assert scans and all("month_key" in x.split("PartitionFilters")[1].split("]")[0] for x in scans)
    assert plan.index("LeftSemi") < max(k for k in range(len(plan)) if plan.startswith("PartitionFilters", k))
    want = fact_order_daily(silver["sales_order_header"], silver["sales_order_detail"]).filter("date_key div 100 in (199903, 199904)")
    assert sorted(fresh.collect()) == sorted(want.collect())


def test_back_dated_and_moved_orders_are_found_by_arrival(spark, silver):
    header = silver["sales_order_header"].filter("order_id < 3000")
    arrive = lambda df, day: df.withColumn("ingested_at", F.lit(day).cast("timestamp"))
    late = (F.col("order_id") % 5 == 0)
    moved = F.col("order_id") % 11 == 0
    first = arrive(header.filter(~late), "2024-01-01")
    second = arrive(header.filter(late | moved), "2024-01-02").withColumn(
        "order_date", F.when(moved, F.expr("add_months(order_date, -1)")).otherwise(F.col("order_date"))
    )
    after = first.filter(~(late | moved)).unionByName(second)
    root, whole = shared_folder(spark, "gold"), shared_folder(spark, "gold")
    load_warehouse(silver | {"sales_order_header": first}, root, date(2001, 9, 1), AS_OF)
    load_warehouse(silver | {"sales_order_header": after}, root, date(2001, 9, 1), AS_OF)
    load_warehouse(silver | {"sales_order_header": after}, whole, date(2001, 9, 1), AS_OF)
    for table in ["fact_order", "fact_order_header", "fact_product_daily", "fact_seller_daily", "fact_order_daily"]:
        one, two = (conform(read_table(spark, r, table), table).collect() for r in (root, whole))
        assert sorted(one, key=str) == sorted(two, key=str), table
    one, two = (read_version(spark, r, "fact_customer_behavior").collect() for r in (root, whole))
    assert sorted(one, key=str) == sorted(two, key=str)


@pytest.mark.parametrize("stamped", [True, False])
def test_lines_that_come_after_their_order(spark, silver, stamped):
    """An order loaded without lines, and one that gets further lines, are complete after the next load."""
    header = silver["sales_order_header"].filter("order_id < 3000").withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp"))
    whole = F.col("order_id") % 7 == 0
    some = (F.col("order_id") % 5 == 0) & (F.pmod(F.xxhash64("order_detail_id"), F.lit(2)) == 0)
    changed = F.col("order_id") % 13 == 1
    lines = silver["sales_order_detail"].join(header.select("order_id"), "order_id", "left_semi")
    if stamped:
        day = F.when(whole | some, F.lit("2024-01-03")).otherwise(F.lit("2024-01-01"))
        lines = lines.withColumn("ingested_at", day.cast("timestamp"))
    late = whole | some
    early = lines.filter(~late)
    if stamped:  # lines sent again with another amount
        early = early.withColumn("line_total", F.when(changed, F.col("line_total") + 1).otherwise(F.col("line_total")).cast("decimal(18,4)"))
        lines = lines.withColumn("ingested_at", F.when(changed, F.lit("2024-01-03").cast("timestamp")).otherwise(F.col("ingested_at")))
    root, once = shared_folder(spark, "gold"), shared_folder(spark, "gold")
    base = silver | {"sales_order_header": header}
    load_warehouse(base | {"sales_order_detail": early}, root, date(2001, 9, 1), AS_OF)
    load_warehouse(base | {"sales_order_detail": lines}, root, date(2001, 9, 1), AS_OF)
    load_warehouse(base | {"sales_order_detail": lines}, once, date(2001, 9, 1), AS_OF)
    for table in ["fact_order", "fact_order_header", "fact_product_daily", "fact_seller_daily", "fact_order_daily"]:
        one, two = (conform(read_table(spark, r, table), table).collect() for r in (root, once))
        assert sorted(one, key=str) == sorted(two, key=str), table
    one, two = (read_version(spark, r, "fact_customer_behavior").collect() for r in (root, once))
    assert sorted(one, key=str) == sorted(two, key=str)
    if stamped:
        marks = {r["table_name"]: r["last_loaded"].date() for r in read_version(spark, root, "load_state").collect()}
        assert marks["fact_order/lines"] == date(2024, 1, 3) and marks["fact_order"] == date(2024, 1, 1)


@pytest.mark.parametrize("by_arrival", [True, False])
def test_increment_follows_moved_orders_and_late_lines(spark, silver, by_arrival):
    """A corrected date takes an order out of its old month; lines that come later are added."""
    header = silver["sales_order_header"].filter("order_id < 1500")
    detail = silver["sales_order_detail"].join(header.select("order_id"), "order_id", "left_semi")
    moved = F.col("order_id") % 11 == 0
    before = header.withColumn("order_date", F.when(moved, F.expr("add_months(order_date, -3)")).otherwise(F.col("order_date")))
    after = header
    if by_arrival:
        before = before.withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp"))
        after = after.withColumn("ingested_at", F.when(moved, F.lit("2024-01-02")).otherwise(F.lit("2024-01-01")).cast("timestamp"))
    late = (F.col("order_id") % 7 == 0) | (F.pmod(F.xxhash64("order_detail_id"), F.lit(9)) == 0)
    root = shared_folder(spark, "gold")
    assert load_increment(before, detail.filter(~late), root, "fact_order_daily", fact_order_daily)
    assert load_increment(after, detail, root, "fact_order_daily", fact_order_daily)
    got = conform(read_table(spark, root, "fact_order_daily"), "fact_order_daily")
    assert sorted(got.collect()) == sorted(fact_order_daily(header, detail).collect())
    if by_arrival:
        assert not load_increment(after, detail, root, "fact_order_daily", fact_order_daily)


def test_loads_leave_stored_tables_only(spark, silver):
    """What a load writes for itself is gone when it ends; the facts are written once."""
    base = spark.conf.get("spark.checkpoint.dir")
    root = shared_folder(spark, "gold")
    dims = load_dimensions(silver, root, AS_OF, loaded_at=F.lit(AS_OF))
    before = set(os.listdir(base))
    load_facts(silver, dims, root, AS_OF)
    tables = add_facts(silver, dims, root, AS_OF)
    assert set(os.listdir(base)) == before
    assert tables["fact_order"].count() > 0
    header, detail = silver["sales_order_header"], silver["sales_order_detail"]
    load_increment(header, detail, root, "again", fact_order_daily)
    months = [m for m in (r["month_key"] for r in read_table(spark, root, "again").select("month_key").distinct().collect())]
    replace_months(fact_order_daily(header, detail), root, "again", [*months, 200912])
    assert set(os.listdir(base)) == before
    assert read_table(spark, root, "again").count() == fact_order_daily(header, detail).count()
