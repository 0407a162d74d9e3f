"""Long histories are built slice by slice of their months, with the results of one build."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from test_widths import exchanged, wide  # noqa: F401

from checks.inputs import AS_OF
from checks.queries import Warehouse
from martwright.plans import refresh
from martwright.plans.facts import keyed_orders, order_lines
from martwright.plans.incremental import lines_with_month, with_month
from martwright.session import configure, shared_folder
from martwright.sources.parquet import read_table, replace_months

TABLES = ["fact_order", "fact_order_header", "fact_product_daily", "fact_order_daily"]


@pytest.fixture(scope="module")
def w(spark, folder):
    return Warehouse(configure(spark), folder)


def test_months_are_cut_by_bytes(monkeypatch):
    monkeypatch.setattr(refresh, "SLICE", 100)
    assert refresh.month_slices([1, 2, 3, 4, 5], 250) == [[1], [2, 3], [4, 5]]
    assert refresh.month_slices([1, None], 10_000) == [[1], [None]]
    assert refresh.month_slices([1, 2, 3], 100) == [[1, 2, 3]] and refresh.month_slices([], 500) == [[]]


def test_slices_give_what_one_build_gives(spark, w, monkeypatch):
    """Orders without a date and lines stored under another month included; a full load drops months that are gone."""
    header = w.order_header.join(w.order_address, "order_id").filter("order_date BETWEEN DATE '1996-05-01' AND DATE '1996-08-31'")
    undated = F.pmod(F.xxhash64("order_id"), F.lit(20)) == 3
    header = with_month(header.withColumn("order_date", F.when(undated, None).otherwise(F.col("order_date")))).cache()
    # the month of some lines is that of an earlier date of their order
    lines = lines_with_month(header, w.order_detail).withColumn(
        "month_key", F.when(F.pmod(F.xxhash64("order_id"), F.lit(20)) == 4, 199605).otherwise(F.col("month_key"))
    ).cache()
    dims = {name: getattr(w, name) for name in ("dim_product", "dim_customer", "dim_seller", "dim_geography")}
    silver = {"sales_order_header": header, "sales_order_detail": lines, "product_inventory": w.inventory}
    early = silver | {"sales_order_header": header.filter((F.col("order_date") < F.lit(date(1996, 7, 10))) | F.col("order_date").isNull())}
    late = silver | {"sales_order_header": header.filter("order_date >= DATE '1996-06-01'")}
    seen, build = [], refresh.order_lines

    def watched(keyed, detail, dim_product):
        seen.append({r[0] for r in detail.select("month_key").distinct().collect()})
        return build(keyed, detail, dim_product)

    def loads():
        root, found = shared_folder(spark, "gold"), []
        for load, of in ((refresh.load_facts, early), (refresh.add_facts, silver), (refresh.load_facts, late)):
            load(of, dims, root, AS_OF)
            found.append({t: sorted(read_table(spark, root, t).collect(), key=str) for t in TABLES})
        return found

    want = loads()
    monkeypatch.setattr(refresh, "SLICE", 1)
    monkeypatch.setattr(refresh, "order_lines", watched)
    got = loads()
    assert [len(x["fact_order"]) for x in got] == [len(x["fact_order"]) for x in want] and all(x["fact_order"] for x in got)
    assert got == want
    # 1996-05 to -07 and no month; the touched months; 1996-06 to -08
    assert len(seen) >= 3 + 1 + 3 and all(len(months) == 1 for months in seen)


def test_slices_have_few_months(monkeypatch):
    monkeypatch.setattr(refresh, "SLICE", 100)
    assert [len(x) for x in refresh.month_slices(list(range(40)), 101)] == [refresh.DIRECT] * 5
    assert len(refresh.month_slices(list(range(40)), 2_000)) == 20 and len(refresh.month_slices(list(range(40)), 100)) == 1


def test_lines_meet_their_product_before_the_header(spark, w, wide):  # noqa: F811
    """Lines that bring their day: the same rows, and no header column is shuffled with them."""
    header = w.order_header.join(w.order_address, "order_id").filter("order_id < 3000")
    header = header.withColumn("order_date", F.when(F.expr("order_id % 20 <> 3"), F.col("order_date")))
    keyed = keyed_orders(header, w.dim_customer, w.dim_geography, w.dim_seller)
    dated = w.order_detail.join(header.select("order_id", "order_date"), "order_id")
    want, got = order_lines(keyed, w.order_detail, w.dim_product), order_lines(keyed, dated, w.dim_product)
    shuffles = [x for x in exchanged(got) if "line_total" in x]
    assert shuffles and not any("customer_key" in x or "total_due" in x for x in shuffles)
    rows = got.collect()
    assert len(rows) > 1000 and sorted(rows, key=str) == sorted(want.collect(), key=str)


def test_a_write_of_few_months_needs_no_shuffle(spark, w):
    """What is not gathered gives the same table, month by month; a month without rows is emptied."""
    df = w.fact_order_daily.filter("date_key < 19960401")
    root = shared_folder(spark, "gold")
    months = sorted({r[0] // 100 for r in df.select("date_key").collect()})
    replace_months(df, root, "t", months)
    replace_months(df.filter(F.expr(f"date_key div 100 <> {months[0]}")), root, "t", months, gather=False)
    left = [r for r in df.collect() if r["date_key"] // 100 != months[0]]
    assert sorted(read_table(spark, root, "t").select(*df.columns).collect(), key=str) == sorted(left, key=str) and left
