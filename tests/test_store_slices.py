"""A long history is loaded from the order store slice by slice of its months, with the rows of one build."""

import pytest
from pyspark.sql import functions as F

from checks.inputs import AS_OF
from checks.queries import INCREMENT_FACTS, Warehouse
from martwright.plans import refresh, stored_loads
from martwright.plans.order_store import OrderStore
from martwright.session import configure, shared_folder


@pytest.fixture(scope="module")
def w(spark, folder):
    return Warehouse(configure(spark), folder)


def test_slices_of_a_store_give_what_one_build_gives(spark, w, monkeypatch):
    orders = w.order_header.join(w.order_address, "order_id").filter("order_date BETWEEN DATE '1996-05-01' AND DATE '1996-06-30'")
    undated = F.pmod(F.xxhash64("order_id"), F.lit(5)) == 3
    orders = orders.withColumn("order_date", F.when(undated, None).otherwise(F.col("order_date"))).cache()
    lines = w.order_detail.join(orders.select("order_id"), "order_id", "left_semi").cache()
    dims = {name: getattr(w, name) for name in ("dim_product", "dim_customer", "dim_seller", "dim_geography")}
    store = OrderStore(spark, shared_folder(spark, "store"), buckets=2)
    store.merge(orders, lines)
    seen, build = [], stored_loads.order_lines

    def watched(keyed, detail, *rest):
        seen.append({r[0] for r in detail.select("month_key").distinct().collect()})
        return build(keyed, detail, *rest)

    def load():
        root = shared_folder(spark, "gold")
        stored_loads.load_stored_facts(store, dims, root, AS_OF)
        return {t: sorted(stored_loads.stored_fact(spark, root, t).collect(), key=str) for t in INCREMENT_FACTS}

    monkeypatch.setattr(stored_loads, "order_lines", watched)
    want = load()
    monkeypatch.setattr(refresh, "SLICE", 1)
    got = load()
    assert seen == [{199605, 199606, None}, {199605}, {199606}, {None}]
    assert got == want and all(want.values())
