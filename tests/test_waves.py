"""Lines dealt to the waves in which a stream gets them."""

from pyspark.sql import functions as F

from checks import queries
from martwright.plans.incremental import details_of


def test_waves_hold_every_line_once(spark, folder, monkeypatch):
    """The waves that semi and anti joins over all lines would give, lines without an order and headers without a status included."""
    w = queries.Warehouse(spark, folder)
    header = w.order_header.filter("order_id % 7 <> 0").withColumn("status", F.when(F.expr("order_id % 5 <> 0"), F.col("status")))
    seen, detail = [], w.order_detail
    monkeypatch.setattr(queries, "materialize", lambda df, label, by: seen.append(label) or df)
    got = {(r["order_detail_id"], r["wave"]) for r in queries._in_waves(header, detail).collect()}
    first = details_of(header.filter((F.col("order_date") < F.lit(queries.CUT)) & (F.col("status") == "F")), detail)
    rest = details_of(header.filter("sales_channel = 'Online'"), detail).join(first.select("order_detail_id"), "order_detail_id", "left_anti")
    ids = [{r[0] for r in df.select("order_detail_id").collect()} for df in (first, rest, detail)]
    want = {(x, 0) for x in ids[0]} | {(x, 1) for x in ids[1]} | {(x, 2) for x in ids[2] - ids[0] - ids[1]}
    assert all(ids) and got == want and len(got) == detail.count() and len(seen) == 1
