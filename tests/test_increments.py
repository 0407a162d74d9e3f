"""What an increment without a store leaves alone: months that only orders without lines join, lines of orders that lack none."""

import os

import pytest
from pyspark.sql import functions as F

from checks.inputs import AS_OF
from checks.queries import Warehouse
from martwright.functions.keys import surrogate_key
from martwright.plans import refresh
from martwright.plans.incremental import lines_with_month, with_month
from martwright.session import configure, scratch_tables, shared_folder
from martwright.sources import parquet
from martwright.sources.parquet import read_months, read_table, replace_months

MONTHS = [199605, 199606, 199607]


@pytest.fixture(scope="module")
def w(spark, folder):
    return Warehouse(configure(spark), folder)


def _files(root, table):
    found = {}
    for base, _, names in os.walk(f"{root.removeprefix('file:')}/{table}"):
        if "month_key=" in base:
            found[int(base.rsplit("=", 1)[1])] = {n for n in names if n.startswith("part-")}
    return found


def test_orders_without_lines_rebuild_no_month(spark, w):
    """They make no row; before, each of their months was built anew by every load."""
    header = w.order_header.join(w.order_address, "order_id").filter("order_date BETWEEN DATE '1996-05-01' AND DATE '1996-07-31'")
    header = with_month(header).cache()
    bare = F.col("month_key").isin(MONTHS[:2]) & (F.pmod(F.xxhash64("order_id"), F.lit(5)) == 1)
    lines = lines_with_month(header, w.order_detail).join(header.filter(bare).select("order_id"), "order_id", "left_anti").cache()
    assert header.filter(bare).select("month_key").distinct().count() == 2
    dims = {name: getattr(w, name) for name in ("dim_product", "dim_customer", "dim_seller", "dim_geography")}
    silver = {"sales_order_header": header, "sales_order_detail": lines, "product_inventory": w.inventory}
    early, root, whole = header.filter("month_key < 199607"), shared_folder(spark, "gold"), shared_folder(spark, "gold")
    refresh.load_facts(silver | {"sales_order_header": early}, dims, root, AS_OF)
    before = {t: _files(root, t) for t in refresh.MONTHLY}
    refresh.add_facts(silver, dims, root, AS_OF)
    refresh.load_facts(silver, dims, whole, AS_OF)
    for t in refresh.MONTHLY:
        after = _files(root, t)
        assert {m: after[m] for m in MONTHS[:2]} == {m: before[t][m] for m in MONTHS[:2]} and after[199607]
        got, want = (sorted(read_table(spark, r, t).collect(), key=str) for r in (root, whole))
        assert got == want and got
    # new orders without lines alone: nothing is rebuilt, and the load ends
    more = header.withColumn("order_id", -F.col("order_id") - 1).limit(3).unionByName(header)
    before = _files(root, "fact_order")
    refresh.add_facts(silver | {"sales_order_header": more}, dims, root, AS_OF)
    assert _files(root, "fact_order") == before and read_table(spark, root, "fact_order").count() == lines.count()


def test_late_lines_are_looked_up_for_differing_orders_only(spark, monkeypatch):
    """Added, swapped and first lines are found; of orders that lack none no line is looked up."""
    known = [(1, "a"), (1, "b"), (2, "c"), (2, "d"), (3, "e"), (5, "g"), (5, "g")]
    now = [(1, "a"), (1, "b"), (2, "c"), (2, "x"), (3, "e"), (3, "y"), (4, "z"), (5, "h"), (5, "h"), (6, "c"), (7, "n")]
    schema = "order_id bigint, order_detail_id string"
    facts = spark.createDataFrame(known, schema).select("order_id", surrogate_key("order_detail_id").alias("fact_order_key"))
    behind = spark.createDataFrame([(k,) for k in range(1, 7)], "order_id bigint")
    looked, inner = [], refresh.absent

    def watched(target, rows, keys):
        looked.append({r["order_id"] for r in rows.collect()})
        return inner(target, rows, keys)

    monkeypatch.setattr(refresh, "absent", watched)
    with scratch_tables(spark):
        found = refresh.late_lines(behind, spark.createDataFrame(now, schema), behind, facts, None, behind)
        # order 6 has one line, which another order holds; 7 is not behind the batch
        assert {r[0] for r in found.collect()} == {2, 3, 4, 5} and looked == [{2, 3, 4, 5, 6}]
        same = refresh.late_lines(behind, spark.createDataFrame(known, schema), behind, facts, None, behind)
        assert same.isEmpty() and len(looked) == 1


def test_a_write_lists_its_own_months_only(spark, monkeypatch):
    root, seen, inner = shared_folder(spark, "gold"), [], parquet._part_files
    df = spark.createDataFrame([(m * 100 + d, d) for m in MONTHS for d in (1, 2)], "date_key int, n int")
    replace_months(df, root, "t", MONTHS)

    def watched(*args):
        seen.append(inner(*args))
        return seen[-1]

    monkeypatch.setattr(parquet, "_part_files", watched)
    replace_months(df.filter("date_key > 19960700"), root, "t", MONTHS[1:])
    assert seen and all(set(x) <= {"month_key=199606", "month_key=199607"} for x in seen)
    assert sorted(r[0] for r in read_table(spark, root, "t").select("date_key").collect()) == [19960501, 19960502, 19960701, 19960702]
    one = read_months(spark, root, "t", "date_key int, n int", [199607])
    assert sorted(map(tuple, one.collect())) == [(19960701, 1, 199607), (19960702, 2, 199607)]
