"""What travels through shuffles, and how wide they are."""

import pytest
from pyspark.sql import functions as F

from checks import queries
from martwright.functions.keys import UNKNOWN_KEY, pack_keys, unpack_keys
from martwright.plans import facts as f
from martwright.session import MANY, WIDTH, fitted_width
from martwright.sources.parquet import by_month


@pytest.fixture
def width(spark):
    before = spark.conf.get(WIDTH, None)
    yield
    spark.conf.unset(WIDTH) if before is None else spark.conf.set(WIDTH, before)


@pytest.fixture
def wide(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_packed_keys_come_back(spark):
    """Hashes, other text of a hash's length or nearly, blank and missing keys; hashes take 33 bytes."""
    digest = "0f" * 32
    texts = [digest, digest.upper(), digest + "\n", digest[:-1], digest[:31], "\x01" + "x" * 32, UNKNOWN_KEY, "7", "", "Zürich", None]
    df = spark.createDataFrame([(t,) for t in texts], "a_key string")
    packed = pack_keys(df, ["a_key"])
    assert [r["a_key"] for r in unpack_keys(packed, ["a_key"]).collect()] == texts
    assert packed.select(F.length("a_key")).first()[0] == 33
    assert packed.distinct().count() == len(texts)


def exchanged(df):
    """Shuffles of a plan, with the width of their rows: the type of each column that passes."""
    found, physical = [], df._jdf.queryExecution().executedPlan()
    todo = [physical.executedPlan() if physical.nodeName() == "AdaptiveSparkPlan" else physical]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            out = node.output()
            found.append({out.apply(i).name(): out.apply(i).dataType().simpleString() for i in range(out.size())})
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_no_shuffle_of_lines_carries_hashed_keys_as_text(spark, folder, wide, width):
    w = queries.Warehouse(spark, folder)
    for df in (w.build("fact_order"), by_month(w.fact_order)):
        lines = [x for x in exchanged(df) if "line_total" in x]
        assert lines and not [x for x in lines for name, kind in x.items() if name.endswith("_key") and kind == "string"]


def test_queries_widen_their_shuffles_with_the_lines(spark, folder, width, monkeypatch):
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    queries.Warehouse(spark, folder)
    assert int(spark.conf.get(WIDTH)) == partitions
    monkeypatch.setattr(queries, "estimated_bytes", lambda df: 2 * 1024**3)
    queries.Warehouse(spark, folder)
    assert int(spark.conf.get(WIDTH)) == 1025
    assert fitted_width(spark, 100 * 1024**4, 16 * 1024**2) == 100 * 1024**4 // (256 * 1024**2) + 1
    assert fitted_width(spark, 1024**4, 16 * 1024**2) == MANY


def test_lines_of_unknown_products_are_dealt_by_order(spark, wide):
    """One key holds all lines of unknown products: they are not shuffled by it, and the sums stay those of one join."""
    product = spark.createDataFrame(
        [(surrogate_key_text(i), i) for i in range(3)] + [(UNKNOWN_KEY, -1)], "product_key string, product_id long"
    ).withColumns({"standard_cost": F.lit(2).cast("decimal(18,4)"), "list_price": F.lit(5).cast("decimal(18,4)")})
    keys = [surrogate_key_text(0), surrogate_key_text(2), "gone", UNKNOWN_KEY, UNKNOWN_KEY, UNKNOWN_KEY]
    rows = [(o, 20240101 + o % 2, k) for o, k in enumerate(keys * 4)] + [(3, 20240102, UNKNOWN_KEY)]
    lines = spark.createDataFrame(rows, "order_id long, date_key int, product_key string").withColumns(
        {"order_qty": F.lit(3), "line_total": F.lit(9).cast("decimal(18,4)"), "unit_price": F.lit(4).cast("decimal(18,4)")}
    )
    daily = f.product_daily_of(lines, product)
    found = {(r["date_key"], r["product_key"]): r for r in daily.collect()}
    for (day, key), row in found.items():
        mine = [x for x in rows if x[1] == day and x[2] == key]
        cost = 2 if key in (surrogate_key_text(0), surrogate_key_text(2)) else None
        assert (row["quantity_sold"], row["order_count"]) == (3 * len(mine), len({x[0] for x in mine}))
        assert row["gross_profit"] == 3 * len(mine) * (4 - (cost or 0)) and row["avg_standard_cost"] == cost
    assert set(found) == {(x[1], x[2]) for x in rows}
    plan = daily._jdf.queryExecution().executedPlan().toString()
    others = [x for x in plan.splitlines() if "hashpartitioning" in x and "order_id" in x]
    assert others, "lines of unknown products are dealt by their order"


def surrogate_key_text(i):
    import hashlib

    return hashlib.sha256(str(i).encode()).hexdigest()
