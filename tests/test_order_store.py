"""The order store and the loads from it: what a batch touches, and nothing else."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks.inputs import AS_OF
from checks.queries import Warehouse
from martwright.plans.facts import (
    fact_customer_behavior,
    fact_order,
    fact_order_daily,
    fact_order_header,
    fact_product_daily,
    fact_seller_daily,
)
from martwright.plans import order_store
from martwright.plans.order_store import OrderStore, differing_places, order_digests, places_of
from martwright.plans.stored_loads import load_stored_facts, load_stored_increment, stored_fact
from martwright.session import configure, shared_folder

FACTS = ["fact_order", "fact_order_header", "fact_product_daily", "fact_seller_daily", "fact_order_daily", "fact_customer_behavior"]


@pytest.fixture(scope="module")
def w(spark, folder):
    return Warehouse(configure(spark), folder)


@pytest.fixture(scope="module")
def sales(w):
    orders = w.order_header.join(w.order_address, "order_id").filter("order_date BETWEEN DATE '1996-05-01' AND DATE '1996-08-31'").cache()
    lines = w.order_detail.join(orders.select("order_id"), "order_id", "left_semi").cache()
    return orders, lines


@pytest.fixture(scope="module")
def dims(w):
    return {name: getattr(w, name) for name in ("dim_product", "dim_customer", "dim_seller", "dim_geography")}


def full(orders, lines, dims):
    both = fact_order(orders, lines, dims["dim_customer"], dims["dim_product"], dims["dim_geography"], dims["dim_seller"])
    return {
        "fact_order": both,
        "fact_order_header": fact_order_header(both),
        "fact_product_daily": fact_product_daily(orders, lines, dims["dim_product"]),
        "fact_seller_daily": fact_seller_daily(orders, lines, dims["dim_seller"]),
        "fact_order_daily": fact_order_daily(orders, lines),
        "fact_customer_behavior": fact_customer_behavior(orders, lines, dims["dim_customer"], AS_OF),
    }


def assert_equal(spark, root, orders, lines, dims, names=FACTS):
    for name, want in full(orders, lines, dims).items():
        if name not in names:
            continue
        got = stored_fact(spark, root, name)
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str), name


def some(one_in, of=0, column="order_id"):
    return F.pmod(F.xxhash64(column), F.lit(one_in)) == of


def test_digests_notice_every_change_of_orders_and_lines(spark, sales):
    orders, lines = (df.filter("order_id < 500") for df in sales)
    place = {"month_key": F.lit(1), "bucket": F.lit(0)}
    base = {r["order_id"]: r["digest"] for r in order_digests(orders.withColumns(place), lines).collect()}
    again = order_digests(orders.withColumns(place).repartition(5), lines.repartition(7).withColumn("ingested_at", F.current_timestamp()))
    assert {r["order_id"]: r["digest"] for r in again.collect()} == base
    one = min(base)
    hit = F.col("order_id") == one
    for changed_orders, changed_lines in [
        (orders.withColumn("customer_id", F.when(hit, -5).otherwise(F.col("customer_id"))), lines),
        (orders, lines.withColumn("line_total", F.when(hit, 0).otherwise(F.col("line_total")).cast("decimal(18,4)"))),
        (orders, lines.filter(~hit)),
        (orders, lines.unionByName(lines.filter(hit).limit(1).withColumn("order_detail_id", F.lit("new").cast(dict(lines.dtypes)["order_detail_id"])))),
    ]:
        got = {r["order_id"]: r["digest"] for r in order_digests(changed_orders.withColumns(place), changed_lines).collect()}
        assert {k for k in base if got[k] != base[k]} == {one}


def test_trees_are_compared_level_by_level(spark):
    rows = [(m, b, 3, m * 100 + b) for m in (1, 2, 3) for b in range(4)] + [(None, 1, 2, 7)]
    shape = "month_key int, bucket int, orders long, digest long"
    before = spark.createDataFrame(rows, shape)
    assert differing_places(before, before) == []
    assert sorted(differing_places(before, None), key=str) == sorted({(m, b) for m, b, _, _ in rows}, key=str)
    now = [r for r in rows if r[:2] not in ((1, 2), (None, 1))] + [(4, 0, 1, 5), (None, 1, 2, 8)]
    now[0] = (1, 0, 3, 99)
    assert sorted(differing_places(spark.createDataFrame(now, shape), before), key=str) == [(1, 0), (1, 2), (4, 0), (None, 1)]


def test_late_moved_corrected_and_removed(spark, sales, dims):
    """Three batches; after each, every fact equals one built in full from what is known by then."""
    orders, lines = sales
    late, moved, bare = some(9), some(11, 1), some(13, 2)
    wrong = F.when(moved, F.add_months("order_date", -3)).otherwise(F.when(some(40, 3), None).otherwise(F.col("order_date")))
    first_orders = orders.filter(~late).withColumn("order_date", wrong).withColumn("customer_id", F.when(some(17, 5), -1).otherwise(F.col("customer_id")))
    corrected, extra, later = some(10, 3, "order_detail_id"), some(12, 4, "order_detail_id"), some(8, 5, "order_detail_id")
    first_lines = lines.filter(~bare & ~later).withColumn("line_total", F.when(corrected, F.col("line_total") + 5).otherwise(F.col("line_total")).cast("decimal(18,4)"))
    store, root = OrderStore(spark, shared_folder(spark, "store"), buckets=2), shared_folder(spark, "gold")
    store.merge(first_orders, first_lines)
    known = first_lines.join(first_orders.select("order_id"), "order_id", "left_semi")
    assert set(load_stored_facts(store, dims, root, AS_OF)) == set(places_of(store.tree()))
    assert_equal(spark, root, first_orders, known, dims, ["fact_order_daily", "fact_customer_behavior"])
    # lines of orders that are late wait in the store
    assert store.waiting().count() == first_lines.count() - known.count() > 0

    # everything is put right, but some orders and lines go; a batch that came twice changes nothing more
    gone = orders.filter(some(20, 7)).select("order_id")
    gone_lines = lines.filter(extra).select("order_id", "order_detail_id")
    changed = orders.filter(late | moved | some(40, 3) | some(17, 5))
    batch_lines = lines.filter((bare | later | corrected) & ~extra)
    after_orders = orders.join(gone, "order_id", "left_anti")
    after_lines = lines.filter(~extra).join(gone, "order_id", "left_anti")
    for k in range(2):
        store.merge(changed.join(gone, "order_id", "left_anti"), batch_lines.join(gone, "order_id", "left_anti"), gone, gone_lines)
        assert bool(load_stored_facts(store, dims, root, AS_OF)) == (k == 0)
    assert_equal(spark, root, after_orders, after_lines, dims)
    assert load_stored_facts(store, dims, root, AS_OF) == []

    # all orders of one customer go: the lifetime row goes with them
    customer = after_orders.groupBy("customer_id").count().orderBy("count").first()["customer_id"]
    theirs = after_orders.filter(F.col("customer_id") == customer).select("order_id")
    places = store.merge(after_orders.filter("false"), after_lines.filter("false"), theirs)
    assert set(load_stored_facts(store, dims, root, AS_OF)) == set(places)
    left = [df.join(theirs, "order_id", "left_anti") for df in (after_orders, after_lines)]
    assert_equal(spark, root, *left, dims, ["fact_order_header", "fact_customer_behavior"])


def _spoil(root, table, places):
    """Overwrite the files of all but the given places, so that whoever reads them fails."""
    kept = {f"month_key={'__HIVE_DEFAULT_PARTITION__' if m is None else m}/bucket={b}" for m, b in places}
    spoiled = 0
    for base, _, files in os.walk(f"{root.removeprefix('file:')}/{table}"):
        if "bucket=" in base and not any(base.endswith(k) for k in kept):
            for name in files:
                with open(os.path.join(base, name), "wb") as out:
                    out.write(b"spoiled")
                spoiled += 1
    assert spoiled


def test_an_increment_reads_only_differing_places(spark, sales, dims):
    """All other lines, headers and order lines are spoiled before the second load; it does not notice."""
    orders, lines = sales
    batch = orders.filter("order_date >= DATE '1996-05-01' AND order_date < DATE '1996-06-01'").filter(some(6))
    store, root = OrderStore(spark, shared_folder(spark, "store"), buckets=3), shared_folder(spark, "gold")
    ids = batch.select("order_id")
    store.merge(orders.join(ids, "order_id", "left_anti"), lines.join(ids, "order_id", "left_anti"))
    load_stored_facts(store, dims, root, AS_OF)
    whole = {n: df.collect() for n, df in full(orders, lines, dims).items()}
    places = store.merge(batch, lines.join(ids, "order_id", "left_semi"))
    assert {m for m, _ in places} == {199605} and 0 < len(places) <= 3
    for table in ("orders", "lines", "digests"):
        _spoil(store.root, table, places)
    for table in ("fact_order", "fact_order_header"):
        _spoil(root, table, places)
    assert set(load_stored_facts(store, dims, root, AS_OF)) == set(places)
    for name in ("fact_product_daily", "fact_seller_daily", "fact_order_daily", "fact_customer_behavior"):
        assert sorted(stored_fact(spark, root, name).collect(), key=str) == sorted(whole[name], key=str), name
    # nothing differs any more: not even these places are read
    for table in ("orders", "lines"):
        _spoil(store.root, table, [])
    assert load_stored_facts(store, dims, root, AS_OF) == []


def test_scans_are_pruned_by_place(spark, sales):
    orders, lines = sales
    store = OrderStore(spark, shared_folder(spark, "store"), buckets=2)
    store.merge(orders, lines)
    for df in (store.orders([(199605, 1), (199606, 0)]), store.lines([(199605, 1), (None, 0)]), store.of_months("lines", [199605])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "month_key" in filters and "bucket" in filters and "order_id" not in filters
    assert {(r["month_key"], r["bucket"]) for r in store.lines([(199605, 1)]).select("month_key", "bucket").distinct().collect()} <= {(199605, 1)}


def test_one_fact_by_month_from_the_store(spark, sales):
    orders, lines = sales
    early = orders.filter(F.col("order_date") < F.lit(date(1996, 7, 1)))
    store, root = OrderStore(spark, shared_folder(spark, "store"), buckets=2), shared_folder(spark, "gold")
    assert not load_stored_increment(store, root, "fact_order_daily", fact_order_daily)
    store.merge(early, lines)
    assert load_stored_increment(store, root, "fact_order_daily", fact_order_daily)
    seen = []

    def build(o, l):
        seen.append({r[0] for r in o.select(F.date_format("order_date", "yyyyMM")).distinct().collect()})
        return fact_order_daily(o, l)

    store.merge(orders.join(early.select("order_id"), "order_id", "left_anti").filter("order_date < DATE '1996-09-01'"), lines.filter("false"))
    assert load_stored_increment(store, root, "fact_order_daily", build) and seen == [{"199607", "199608"}]
    assert not load_stored_increment(store, root, "fact_order_daily", build)
    known = orders.filter("order_date < DATE '1996-09-01'")
    assert sorted(stored_fact(spark, root, "fact_order_daily").collect()) == sorted(fact_order_daily(known, lines).collect())


def test_hot_order_and_empty_batches(spark, sales, dims):
    """One order holds most lines; batches without rows and lines without any order."""
    orders, lines = (df.filter("order_id < 500") for df in sales)
    hot = min(r["order_id"] for r in orders.collect())
    more = lines.filter(F.col("order_id") == hot).limit(1).crossJoin(spark.range(3_000))
    more = more.withColumn("order_detail_id", F.concat(F.lit("hot"), F.col("id").cast("string"))).select(*lines.columns)
    store, root = OrderStore(spark, shared_folder(spark, "store"), buckets=2), shared_folder(spark, "gold")
    assert store.merge(orders.filter("false"), lines.filter("order_id = -1")) == []
    assert load_stored_facts(store, dims, root, AS_OF) == []
    assert store.merge(orders.filter("false"), lines) == []
    store.merge(orders, more)
    load_stored_facts(store, dims, root, AS_OF)
    assert_equal(spark, root, orders, lines.unionByName(more), dims, ["fact_product_daily", "fact_customer_behavior"])
    assert store.merge(orders.filter("false"), lines.filter("false")) == []


def test_lines_pass_once_and_none_is_lost_to_a_run_that_died(spark, sales, monkeypatch):
    """A first batch stores its lines without a copy beside them; the run dies before its tree, and is run again."""
    orders, lines = (df.filter("order_id < 500") for df in sales)
    late = lines.filter(some(3))
    store = OrderStore(spark, shared_folder(spark, "store"), buckets=2)
    assert store.merge(orders.filter("false"), late) == [] and store.waiting().count() == late.count() > 0
    copied, write, keep = [], order_store.write_version, order_store.materialize

    def dies(df, root, table, *more):
        if table == "tree":
            raise OSError("died")
        return write(df, root, table, *more)

    monkeypatch.setattr(order_store, "write_version", dies)
    monkeypatch.setattr(order_store, "materialize", lambda df, label, *more: copied.extend(df.columns) or keep(df, label, *more))
    with pytest.raises(OSError):
        store.merge(orders.filter(~some(5)), lines.filter(~some(3)))
    assert "line_total" not in copied
    monkeypatch.undo()
    store.merge(orders.filter(~some(5)), lines.filter(~some(3)))
    assert sorted(r[0] for r in store.lines().select("order_detail_id").collect()) == sorted(r[0] for r in lines.filter(~some(5)).select("order_detail_id").collect())
    assert sorted(r[0] for r in store.waiting().select("order_detail_id").collect()) == sorted(r[0] for r in lines.filter(some(5)).select("order_detail_id").collect())
