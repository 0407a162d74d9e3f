"""Facts against plain Python over skewed orders: one order, product, customer, seller and day
each hold about a third of the lines."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal as D

import pytest
from pyspark.sql import functions as F

from checks.queries import Warehouse
from martwright.functions.labels import rfm_segment
from martwright.plans import facts as f
from martwright.plans import incremental as inc
from martwright.session import configure

AS_OF = date(2024, 12, 31)
SPLIT = date(2024, 3, 1)
CENT4 = D("0.0001")


def cut(x):
    return x.quantize(CENT4, ROUND_HALF_UP)


def key_of(day):
    return day.year * 10000 + day.month * 100 + day.day


@pytest.fixture(scope="module")
def sales(spark):
    dice = random.Random(11)

    def pick(hot, others):
        return hot if dice.random() < 0.34 else dice.choice(others)

    headers, lines = [], []
    for o in range(300):
        day = pick(date(2024, 5, 5), [date(2024, 1, 1) + timedelta(days=n) for n in range(150)])
        customer = pick(1, [*range(2, 40), None, 998, 999])
        seller = pick(None, [7, 8, 9, 55])
        headers.append((o, customer, seller, day, "Online" if seller is None else "Offline", D(o), D(1), D(2), D(o + 3)))
    for n in range(1500):
        order = pick(0, range(1, 320))  # orders 300+ have no header, some orders no lines
        product = pick(1, [*range(2, 30), 777, 888])
        qty, price = dice.randint(1, 9), D(dice.randint(1, 99999)) / 100
        discount = dice.choice([None, D("0.05"), D("0.1000"), D("0")])
        lines.append((order, f"{order}-{n}", product, qty, price, discount, cut(price * qty * (1 - (discount or 0)))))
    header = spark.createDataFrame(
        headers,
        "order_id long, customer_id long, sales_person_id long, order_date date, sales_channel string, "
        "sub_total decimal(18,4), tax_amt decimal(18,4), freight_amt decimal(18,4), total_due decimal(18,4)",
    )
    detail = spark.createDataFrame(
        lines,
        "order_id long, order_detail_id string, product_id long, order_qty int, unit_price decimal(18,4), "
        "unit_price_discount decimal(10,4), line_total decimal(18,4)",
    )
    versions, products = [], []
    for p in range(1, 30):
        for v, (start, end) in enumerate([(date(2023, 1, 1), SPLIT), (SPLIT, None)], 1):
            versions.append((p, v, start, end, D(p + v), D(2 * p + v)))
            products.append((f"p{p}v{v}", p, D(p + v), D(2 * p + v), start, end, end is None, v))
    dim_product = spark.createDataFrame(
        products,
        "product_key string, product_id long, standard_cost decimal(18,4), list_price decimal(18,4), "
        "effective_date date, expiry_date date, is_current boolean, version int",
    )
    dim_customer = spark.createDataFrame(
        [(f"c{c}", c, True) for c in range(1, 40)] + [(f"old{c}", c, False) for c in range(1, 40)],
        "customer_key string, customer_id long, is_current boolean",
    )
    dim_seller = spark.createDataFrame(
        [(f"s{s}", s, D("1.50"), True) for s in (7, 8, 9)],
        "seller_key string, seller_id long, commission_pct decimal(5,2), is_current boolean",
    )
    by_order = {h[0]: h for h in headers}
    joined = [(by_order[l[0]], l) for l in lines if l[0] in by_order]

    def product_at(p, day):
        for pid, v, start, end, cost, lst in versions:
            if pid == p and day >= start and (end is None or day < end):
                return f"p{p}v{v}", cost, lst
        return "UNKNOWN", None, None

    return {
        "header": header,
        "detail": detail,
        "product": dim_product,
        "customer": dim_customer,
        "seller": dim_seller,
        "joined": joined,
        "product_at": product_at,
    }


def revenue(line):
    return line[4] * line[3] * (1 - (line[5] or 0))


def test_fact_product_daily(sales):
    groups = defaultdict(list)
    for h, l in sales["joined"]:
        pk, cost, lst = sales["product_at"](l[2], h[3])
        groups[key_of(h[3]), pk].append((l, cost, lst))
    expected = {
        k: (
            sum(l[3] for l, _, _ in g),
            sum(l[6] for l, _, _ in g),
            sum((l[4] - (cost or 0)) * l[3] for l, cost, _ in g),
            len({l[0] for l, _, _ in g}),
            g[0][1],
            g[0][2],
        )
        for k, g in groups.items()
    }
    got = f.fact_product_daily(sales["header"], sales["detail"], sales["product"]).collect()
    assert len({r["fact_product_daily_key"] for r in got}) == len(got)
    assert {
        (r["date_key"], r["product_key"]): (
            r["quantity_sold"],
            r["revenue"],
            r["gross_profit"],
            r["order_count"],
            r["avg_standard_cost"],
            r["avg_list_price"],
        )
        for r in got
    } == expected


def test_fact_seller_daily(sales):
    groups = defaultdict(list)
    for h, l in sales["joined"]:
        groups[key_of(h[3]), f"s{h[2]}" if h[2] in (7, 8, 9) else "UNKNOWN"].append((h, l))
    expected = {
        (day, sk): (
            len({h[0] for h, _ in g}),
            len({h[1] for h, _ in g if h[1] is not None}),
            sum(l[3] for _, l in g),
            cut(sum(revenue(l) for _, l in g)),
            cut(sum(revenue(l) for _, l in g) * (0 if sk == "UNKNOWN" else D("0.015"))),
        )
        for (day, sk), g in groups.items()
    }
    got = f.fact_seller_daily(sales["header"], sales["detail"], sales["seller"]).collect()
    assert {
        (r["date_key"], r["seller_key"]): (
            r["order_count"],
            r["customer_count"],
            r["quantity_sold"],
            r["revenue"],
            r["commission_earned"],
        )
        for r in got
    } == expected


def test_fact_order_daily(sales):
    groups = defaultdict(list)
    for h, l in sales["joined"]:
        groups[key_of(h[3])].append((h, l))
    got = {r["date_key"]: r for r in f.fact_order_daily(sales["header"], sales["detail"]).collect()}
    assert set(got) == set(groups)
    for day, g in groups.items():
        total, orders = sum(revenue(l) for _, l in g), {h[0] for h, _ in g}
        r = got[day]
        assert r["daily_order_count"] == len(orders)
        assert r["daily_customer_count"] == len({h[1] for h, _ in g if h[1] is not None})
        assert r["daily_quantity"] == sum(l[3] for _, l in g)
        assert r["daily_revenue"] == cut(total)
        assert r["average_order_value"] == cut(total / len(g))
        assert r["avg_order_total"] == cut(total / len(orders))


def test_fact_customer_behavior(sales):
    groups = defaultdict(list)
    for h, l in sales["joined"]:
        groups[f"c{h[1]}" if h[1] and h[1] < 40 else "UNKNOWN"].append((h, l))
    got = f.fact_customer_behavior(sales["header"], sales["detail"], sales["customer"], AS_OF).collect()
    assert len(got) == len(groups)
    for r in got:
        g = groups[r["customer_key"]]
        orders, amount = {h[0] for h, _ in g}, sum(l[6] for _, l in g)
        last = max(h[3] for h, _ in g)
        assert (r["total_orders"], r["total_quantity"], r["total_amount"]) == (len(orders), sum(l[3] for _, l in g), amount)
        assert (r["avg_order_value"], r["avg_order_total"]) == (cut(amount / len(g)), cut(amount / len(orders)))
        assert (r["first_purchase"], r["last_purchase"]) == (min(h[3] for h, _ in g), last)
        assert r["recency_days"] == (AS_OF - last).days


def test_fact_order_keeps_every_line_once(spark, sales):
    places = spark.createDataFrame([], "geography_key string, address_id long")
    got = f.fact_order(
        sales["header"], sales["detail"], sales["customer"], sales["product"], places, sales["seller"]
    ).collect()
    assert len(got) == len(sales["joined"]) == len({r["fact_order_key"] for r in got})
    expected = sorted(
        (
            h[0],
            f"c{h[1]}" if h[1] and h[1] < 40 else "UNKNOWN",
            sales["product_at"](l[2], h[3])[0],
            f"s{h[2]}" if h[2] in (7, 8, 9) else "UNKNOWN",
            l[6],
            h[8],
        )
        for h, l in sales["joined"]
    )
    names = ["order_id", "customer_key", "product_key", "seller_key", "line_total", "total_due"]
    assert sorted(tuple(r[n] for n in names) for r in got) == expected
    assert {r["geography_key"] for r in got} == {"UNKNOWN"}


BUILDS = {
    "order": lambda s: f.fact_order_daily,
    "seller": lambda s: lambda h, l: f.fact_seller_daily(h, l, s["seller"]),
    "product": lambda s: lambda h, l: f.fact_product_daily(h, l, s["product"]),
}


@pytest.mark.parametrize("fact", BUILDS)
@pytest.mark.parametrize("day", [date(2024, 1, 1), date(2024, 3, 15), date(2024, 5, 5), date(2025, 1, 1)])
def test_two_loads_equal_one(sales, fact, day):
    header, detail, build = sales["header"], sales["detail"], BUILDS[fact](sales)
    stored = build(header.filter(F.col("order_date") < F.lit(day)), detail)
    twice = inc.refresh_since(stored, header, detail, build, day)
    assert sorted(twice.collect()) == sorted(build(header, detail).collect())


def test_late_batch_equals_full_load_and_rerun_changes_nothing(sales):
    header, detail, build = sales["header"], sales["detail"], BUILDS["product"](sales)
    late = (F.col("order_id") % 7 == 0) | (F.col("order_id") == 0)
    stored = build(header.filter(~late), detail)
    days = inc.touched_days(header.filter(late))
    once = inc.refresh_days(stored, header, detail, days, build)
    again = inc.refresh_days(once, header, detail, days, build)
    full = sorted(build(header, detail).collect())
    columns = build(header, detail).columns
    assert sorted(once.select(columns).collect()) == full == sorted(again.select(columns).collect())


def test_months_of_a_batch(spark):
    rows = [(date(2024, 2, 10),), (date(2024, 2, 11),), (date(2023, 12, 31),), (None,)]
    orders = spark.createDataFrame(rows, "order_date date")
    assert sorted(inc.months_of(orders), key=str) == [202312, 202402, None]
    assert inc.of_months(orders, [202402], "order_date").count() == 2
    assert inc.of_months(orders, [202312, None], "order_date").count() == 2
    assert inc.of_months(orders, [], "order_date").count() == 0
    assert inc.of_months(inc.with_month(orders), [None]).count() == 1


def test_affected_customers_include_all_unknown_ones(sales):
    header, detail, dim = sales["header"], sales["detail"], sales["customer"]
    new = header.filter(F.col("order_date") >= F.lit(SPLIT))
    stored = f.fact_customer_behavior(header.filter(F.col("order_date") < F.lit(SPLIT)), detail, dim, AS_OF)
    got = inc.refresh_customers(stored, new, header, detail, dim, AS_OF)
    assert sorted(got.collect()) == sorted(f.fact_customer_behavior(header, detail, dim, AS_OF).collect())


def test_new_customer_version_updates_its_row(spark, sales):
    header, detail, dim = sales["header"], sales["detail"], sales["customer"]
    stored = f.fact_customer_behavior(header, detail, dim, AS_OF)
    renamed = dim.withColumn("customer_key", F.concat(F.lit("new-"), "customer_key"))
    got = inc.refresh_customers(stored, header, header, detail, renamed, AS_OF)
    assert got.count() == stored.count()
    assert got.filter("customer_key NOT LIKE 'new-%'").count() == 1  # the unknown row


def test_details_of_never_repeats_a_line(sales):
    twice = sales["header"].union(sales["header"])
    assert inc.details_of(twice, sales["detail"]).count() == len(sales["joined"])


def test_inventory_uses_the_current_version_only(spark, sales):
    stock = spark.createDataFrame([(1, 1, "A", 1, 5), (777, 1, "B", 2, 0)], "product_id long, location_id int, shelf string, bin int, quantity int")
    got = f.fact_inventory(stock, sales["product"]).collect()
    assert {(r["product_key"], r["quantity"]) for r in got} == {("p1v2", 5), ("UNKNOWN", 0)}


def test_segments(spark):
    cases = [
        (10, "10000", 0, "VIP"),
        (10, "9999.9999", 0, "Loyal"),
        (5, "1", 999, "Loyal"),
        (4, "1", 366, "Lost"),
        (4, "1", 365, "Regular"),
        (9, "99999", 0, "Loyal"),
    ]
    df = spark.createDataFrame([(o, D(a), r, s) for o, a, r, s in cases], "o int, a decimal(18,4), r int, s string")
    wrong = df.filter(rfm_segment(F.col("a"), F.col("o"), F.col("r")) != F.col("s"))
    assert wrong.count() == 0


def test_mark_of_a_table_never_loaded(spark):
    from martwright.schemas import empty_table

    state = empty_table(spark, "load_state")
    assert inc.read_mark(state, "x") is None
    marked = inc.advance_mark(state, inc.orders_mark(spark.sql("SELECT DATE '2024-02-03' AS order_date"), "x"))
    assert inc.read_mark(marked, "x") == date(2024, 2, 3)
    null_mark = inc.advance_mark(marked, inc.orders_mark(spark.sql("SELECT CAST(NULL AS DATE) AS order_date"), "x"))
    assert inc.read_mark(null_mark, "x") is None


def test_never_loaded_means_no_filter(spark):
    header = spark.sql("SELECT DATE '1815-06-18' AS order_date UNION ALL SELECT CAST(NULL AS DATE)")
    assert inc.orders_since(header, None).count() == 2
    assert inc.orders_since(header, date(1900, 1, 1)).count() == 1
    stamped = header.withColumn("ingested_at", F.lit(None).cast("timestamp"))
    assert inc.arrived_since(stamped, datetime(2024, 1, 1)).count() == 2


def test_net_revenue_is_rounded_once(spark):
    """Four-decimal prices and discounts need eight decimals until the day is added up."""
    lines = spark.range(4000).selectExpr(
        "id AS order_id", "1 AS order_qty", "CAST(0.0013 AS DECIMAL(18,4)) AS unit_price",
        "CAST(0.1234 AS DECIMAL(10,4)) AS unit_price_discount", "CAST(0.0011 AS DECIMAL(18,4)) AS line_total",
    )
    header = spark.range(4000).selectExpr("id AS order_id", "DATE '2024-05-06' AS order_date", "id AS customer_id", "7L AS sales_person_id")
    exact = (4000 * D("0.0013") * (1 - D("0.1234"))).quantize(CENT4, ROUND_HALF_UP)
    assert exact == D("4.5583")
    assert f.fact_order_daily(header, lines).first()["daily_revenue"] == exact
    seller = spark.createDataFrame([("k", 7, D("12.50"), True)], "seller_key string, seller_id bigint, commission_pct decimal(5,2), is_current boolean")
    row = f.fact_seller_daily(header, lines, seller).first()
    assert row["revenue"] == exact
    assert row["commission_earned"] == (4000 * D("0.0013") * (1 - D("0.1234")) * D("0.125")).quantize(CENT4, ROUND_HALF_UP)


def test_order_headers_do_not_need_the_order_lines(spark, folder):
    """Reports per order build no fact of lines first; orders without lines stay out."""
    w = Warehouse(configure(spark), folder)
    header = w.build("fact_order_header")
    assert not [f for f in header.inputFiles() if "/fact_order-" in f]
    assert sorted(header.collect()) == sorted(f.fact_order_header(w.fact_order).collect())
