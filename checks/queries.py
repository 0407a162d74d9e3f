"""Every registered query: ``(spark, folder) -> DataFrame`` over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import AS_OF, FIRST_DAY, REPRICED_ON, Inputs
from martwright.functions.keys import change_hash
from martwright.operators import cleaning as c
from martwright.operators.history import splice_snapshot
from martwright.operators.lookup import overlapping_versions
from martwright.operators.merge import duplicate_keys, full_refresh, scd2_merge, start_history, upsert
from martwright.operators.rejects import screen
from martwright.plans import analytics as a
from martwright.plans import dimensions as d
from martwright.plans import facts as f
from martwright.plans import incremental as inc
from martwright.plans import silver as s
from martwright.plans.clusters import cluster_check, clustered, customer_clusters
from martwright.plans.order_store import OrderStore
from martwright.plans.refresh import add_facts, load_facts, load_increment, load_warehouse
from martwright.schemas import add_versioning, conform, empty_table
from martwright.session import configure, estimated_bytes, materialize, shared_folder, widen_shuffles
from martwright.sources.ingest import ingest
from martwright.sources.parquet import (
    append_table,
    read_table,
    read_version,
    replace_months,
    write_table,
    write_version,
)
from martwright.plans.stored_loads import load_stored_facts, load_stored_increment, stored_fact
from martwright.streaming.incremental import load_late_lines, order_files, start_load

BEST_SELLER = "Supplier#000000001"
CUT = date(2000, 1, 1)
MIDDLE = date(1997, 3, 1)


# (application, folder, table) -> stored table; each is built once per Spark application
STORED: dict[tuple[str, str, str], DataFrame] = {}
FOLDERS: dict[tuple[str, str, str], str] = {}


class Warehouse(Inputs):
    """The warehouse over one driver folder.

    As in production each layer reads the stored tables of the layer below: conformed orders
    and lines (unique per key, spread over files by that deduplication), then dimensions,
    whose file sizes tell Spark which of them to broadcast, then facts for the reports.
    ``build`` makes a table anew as a lazy plan; ``w.<table>`` is the stored one.
    """

    BUILDERS: dict[str, Callable[["Warehouse"], DataFrame]] = {
        "order_header": lambda w: c.one_row_per_key(w.input("order_header"), ["order_id"]),
        "order_detail": lambda w: c.one_row_per_key(w.input("order_detail"), ["order_detail_id"]),
        "dim_product": lambda w: d.load_versions(
            d.load_versions(None, w.product_v1, "dim_product", FIRST_DAY),
            w.product_v2,
            "dim_product",
            REPRICED_ON,
        ),
        "dim_customer": lambda w: d.load_versions(
            d.load_versions(None, w.customer_v1, "dim_customer", FIRST_DAY),
            w.customer_v2,
            "dim_customer",
            REPRICED_ON,
        ),
        "dim_seller": lambda w: d.load_versions(None, w.seller, "dim_seller", FIRST_DAY),
        "dim_geography": lambda w: d.load_geography(None, w.geography, F.lit(AS_OF)),
        "dim_vendor": lambda w: d.load_vendor(None, w.vendor, F.lit(AS_OF)),
        "dim_date": lambda w: d.dim_date(
            w.order_header.agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))
        ),
        "fact_order": lambda w: f.fact_order(
            w.order_header.join(w.order_address, "order_id"),
            w.order_detail,
            w.dim_customer,
            w.dim_product,
            w.dim_geography,
            w.dim_seller,
        ),
        "fact_order_header": lambda w: f.orders_of(
            f.keyed_orders(w.order_header.join(w.order_address, "order_id"), w.dim_customer, w.dim_geography, w.dim_seller),
            w.order_detail,
        ),
        "fact_product_daily": lambda w: f.fact_product_daily(w.order_header, w.order_detail, w.dim_product),
        "fact_seller_daily": lambda w: f.fact_seller_daily(w.order_header, w.order_detail, w.dim_seller),
        "fact_order_daily": lambda w: f.fact_order_daily(w.order_header, w.order_detail),
        "fact_inventory": lambda w: f.fact_inventory(w.inventory, w.dim_product),
        "fact_customer_behavior": lambda w: f.fact_customer_behavior(
            w.order_header, w.order_detail, w.dim_customer, AS_OF
        ),
    }

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder)
        # AQE never widens a shuffle: what one task holds of the lines would grow with them
        widen_shuffles(spark, sum(estimated_bytes(self.table(name)) for name in ("orders", "lineitem")))

    def build(self, name: str) -> DataFrame:
        return self.BUILDERS[name](self)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.BUILDERS:
            return super().__getattr__(name)
        place = (self.spark.sparkContext.applicationId, self.folder, name)
        if place not in STORED:
            STORED[place] = materialize(self.build(name), name)
        return STORED[place]


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """Register a query under its function name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Warehouse(configure(spark), folder))

    QUERIES[build.__name__] = run
    return build


# ---------------------------------------------------------------- sources and sinks


@query
def scan_parquet_lineitem(w):
    return w.input("order_detail")


@query
def ingest_batch_report(w):
    tables = ["region", "nation", "supplier", "customer", "part", "orders", "lineitem", "no_such_table"]
    root = shared_folder(w.spark, "raw")
    report = ingest(w.spark, tables, w.table, root, datetime(2001, 8, 2))
    return report.select("table_name", "status", "row_count")


@query
def parquet_version_roundtrip(w):
    """Two versions of a dimension side by side; readers get the newest."""
    root = shared_folder(w.spark, "gold")
    first = d.load_versions(None, w.product_v1, "dim_product", FIRST_DAY)
    write_version(first, root, "dim_product", ["is_current"])
    stored = conform(read_version(w.spark, root, "dim_product"), "dim_product")
    merged = d.load_versions(stored, w.product_v2, "dim_product", REPRICED_ON)
    write_version(merged, root, "dim_product", ["is_current"])
    return conform(read_version(w.spark, root, "dim_product"), "dim_product")


@query
def parquet_append(w):
    root = shared_folder(w.spark, "raw")
    write_table(w.nation.select(F.col("n_name").alias("name")), root, "names")
    append_table(w.supplier.select(F.col("s_name").alias("name")), root, "names")
    return read_table(w.spark, root, "names")


@query
def schema_evolution_add_columns(w):
    old = w.supplier.select(
        F.sha2(F.col("s_suppkey").cast("string"), 256).alias("seller_key"),
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_name").alias("seller_name"),
    )
    return add_versioning(old, "dim_seller", FIRST_DAY)


@query
def run_sql_by_name(w):
    """User SQL over gold tables with a named parameter."""
    return a.run_query(
        w.spark,
        """SELECT sales_channel, count(*) AS n_lines, CAST(sum(line_total) AS DECIMAL(28,4)) AS revenue
           FROM {fact_order} WHERE date_key >= :first_day GROUP BY sales_channel""",
        {"fact_order": w.fact_order},
        {"first_day": 19980101},
    )


# ---------------------------------------------------------------- cleaning

DIRTY_PART = """
SELECT p_partkey AS id, concat('  ', p_name, ' ') AS name,
       CASE WHEN p_size < 10 THEN '   ' WHEN p_size < 20 THEN '' WHEN p_size < 30 THEN NULL ELSE concat(' ', p_brand) END AS brand,
       p_size AS size
FROM {part}"""

DIRTY_CONTACT = """
SELECT s_suppkey AS id, concat(s_name, '@Mail.Example.COM') AS work_email, s_name AS name,
       concat('+(', CAST(s_nationkey AS STRING), ') ', CAST(s_suppkey AS STRING), '-00 ext. 9') AS Phone,
       s_nationkey AS phone_type_id
FROM {supplier}"""

DIRTY_LINES = """
SELECT CASE WHEN l_quantity = 13 THEN NULL ELSE l_orderkey END AS order_id, l_linenumber AS line,
       l_partkey AS part, l_suppkey AS supplier, l_returnflag AS flag, CAST(l_extendedprice AS DECIMAL(12,2)) AS price
FROM {lineitem}"""

DIRTY_ORDERS = """
SELECT o_orderkey AS id,
       CASE WHEN o_orderstatus = 'P' THEN 'abc' WHEN o_orderpriority = '5-LOW' THEN '' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END AS amount,
       CASE WHEN o_orderstatus = 'O' THEN '12x' ELSE CAST(o_custkey AS STRING) END AS qty,
       CASE WHEN o_orderstatus = 'F' THEN '2024-02-30' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS day,
       CASE WHEN o_orderstatus = 'O' THEN 'soon' ELSE CAST(o_orderdate AS STRING) END AS moment
FROM {orders}"""

DIRTY_CUSTOMERS = """
SELECT CASE WHEN c_nationkey = 4 THEN NULL ELSE c_custkey END AS id, concat(' ', c_name, '  ') AS name,
       CASE WHEN c_acctbal < 0 THEN '  ' ELSE concat(c_mktsegment, '@X.Org ') END AS email_address,
       concat('00', CAST(c_nationkey AS STRING), '/', CAST(c_custkey AS STRING)) AS phone, CAST(c_acctbal AS DECIMAL(18,4)) AS balance
FROM {customer}"""


@query
def clean_strings(w):
    return w.sql(DIRTY_PART).transform(c.trim_strings).transform(c.blank_to_null)


@query
def clean_blank_to_null(w):
    """Without trimming: padded text keeps its padding."""
    return w.sql(DIRTY_PART).transform(c.blank_to_null)


@query
def clean_lower_case(w):
    return c.standard_clean(w.sql(DIRTY_PART), lower_case=True, audit=False)


@query
def clean_email_phone(w):
    return w.sql(DIRTY_CONTACT).transform(c.lower_emails).transform(c.digits_only_phones)


@query
def clean_title_case(w):
    shouted = w.part.select("p_partkey", F.upper("p_name").alias("p_name"))
    return c.capitalize(shouted, ["p_name", "no_such_column"])


@query
def clean_keys_dedupe(w):
    keys = ["order_id", "line"]
    return w.sql(DIRTY_LINES).transform(c.drop_null_keys, keys).transform(c.one_row_per_key, keys)


@query
def clean_casts(w):
    return (
        w.sql(DIRTY_ORDERS)
        .transform(c.to_decimal, ["amount"], 7, 2)
        .transform(c.to_integer, ["qty"])
        .transform(c.to_day, ["day"])
        .transform(c.to_instant, ["moment"])
    )


@query
def clean_positive(w):
    accounts = w.customer.select(
        "c_custkey",
        F.col("c_acctbal").cast("decimal(18,4)").alias("balance"),
        F.when(F.col("c_nationkey") == 3, None).otherwise(F.col("c_nationkey") - 1).alias("level"),
    )
    return c.keep_non_negative(accounts, ["balance", "level", "no_such_column"])


@query
def clean_fill(w):
    gaps = w.customer.select(
        "c_custkey",
        F.when(F.col("c_nationkey") > 3, F.col("c_name")).alias("name"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("decimal(18,4)")).alias("balance"),
        F.when(F.col("c_nationkey") > 9, F.col("c_acctbal") > 0).alias("active"),
    )
    return c.fill_missing(gaps, {"name": "Unknown", "balance": 0, "active": False, "no_such_column": 1})


@query
def generic_clean_audit(w):
    return c.standard_clean(w.sql(DIRTY_CUSTOMERS), ["id"]).drop("_processed_at")


# ---------------------------------------------------------------- conformed tables


def _silver(table: str) -> Query:
    build, sources = s.SILVER_TABLES[table]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        w = Inputs(configure(spark), folder)
        return build(*[w.raw(name) for name in sources])

    return run


QUERIES |= {
    "silver_customer": _silver("customer"),
    "silver_product": _silver("product"),
    "silver_geography": _silver("geography"),
    "silver_sales_header": _silver("sales_order_header"),
    "silver_sales_detail": _silver("sales_order_detail"),
    "silver_vendor": _silver("vendor"),
    "silver_seller": _silver("seller"),
    "silver_inventory": _silver("product_inventory"),
}


# ---------------------------------------------------------------- dimensions


@query
def dim_date(w):
    return w.build("dim_date")


@query
def dim_product(w):
    return d.load_versions(None, w.product_v1, "dim_product", FIRST_DAY)


@query
def dim_customer(w):
    return d.load_versions(None, w.customer_v1, "dim_customer", FIRST_DAY)


@query
def dim_seller(w):
    return w.build("dim_seller")


@query
def dim_geography(w):
    return w.build("dim_geography").drop("created_at")


@query
def dim_vendor(w):
    return w.build("dim_vendor").drop("created_at")


@query
def dim_vendor_positions(w):
    """Vendors keyed 1, 2, 3 … in id order, numbered without a single-task window."""
    return d.with_position_key(d.dim_vendor(w.vendor, F.lit(AS_OF)), "dim_vendor").drop("created_at")


# ---------------------------------------------------------------- merges


@query
def upsert_scd1(w):
    """A batch with a changed column for some suppliers, and some new ones."""
    target = w.supplier.select("s_suppkey", "s_name", F.col("s_acctbal").cast("decimal(18,4)").alias("s_acctbal"))
    changed = w.supplier.filter("s_acctbal < 5000").select(
        "s_suppkey", (F.col("s_acctbal").cast("decimal(18,4)") + 1).cast("decimal(18,4)").alias("s_acctbal")
    )
    added = w.supplier.filter("s_nationkey = 3").select(
        (-F.col("s_suppkey") - 1).alias("s_suppkey"), F.lit(None).cast("decimal(18,4)").alias("s_acctbal")
    )
    return upsert(target, changed.unionByName(added), ["s_suppkey"])


@query
def unknown_member_insert(w):
    """Seeding a stored dimension twice adds the member once."""
    stored = d.dim_vendor(w.vendor, F.lit(AS_OF))
    once = d.seed_stored(stored, "dim_vendor")
    return d.seed_stored(once, "dim_vendor").drop("created_at")


@query
def scd2_first_load(w):
    """Valid from the day of the load, not from the start of history."""
    return d.load_versions(None, w.product_v1, "dim_product", REPRICED_ON)


@query
def scd2_second_load(w):
    first = d.load_versions(None, w.product_v1, "dim_product", FIRST_DAY)
    return d.load_versions(first, w.product_v2, "dim_product", REPRICED_ON)


@query
def scd2_noop(w):
    """The same snapshot once more, a month later: nothing changes."""
    first = d.load_versions(None, w.product_v1, "dim_product", FIRST_DAY)
    second = d.load_versions(first, w.product_v2, "dim_product", REPRICED_ON)
    return d.load_versions(second, w.product_v2, "dim_product", date(1998, 8, 1))


@query
def scd2_same_day(w):
    """A second change on one day replaces that day's version."""
    first = d.load_versions(None, w.product_v1, "dim_product", FIRST_DAY)
    second = d.load_versions(first, w.product_v2, "dim_product", REPRICED_ON)
    return d.load_versions(second, w.product_v1, "dim_product", REPRICED_ON)


@query
def scd2_out_of_order(w):
    """Three product snapshots, the newest first: the history is the one of their days in order; withdrawn products end."""
    middle = w.product_v1.filter("size <> '49'").withColumn(
        "list_price", F.when(F.col("category_name") == "PROMO", F.col("list_price") + 1).otherwise(F.col("list_price")).cast("decimal(18,4)")
    )
    snapshots = {REPRICED_ON: w.product_v2, MIDDLE: middle, FIRST_DAY: w.product_v1}
    history, known = empty_table(w.spark, "dim_product"), []
    tracked = [col for col in w.product_v1.columns if col != "product_id"]
    for day, snapshot in snapshots.items():
        history = materialize(splice_snapshot(history, snapshot, "product_id", "product_key", tracked, day, known), "history")
        known.append(day)
    return history


@query
def scd2_change_hash(w):
    """The stored form of the change test: one hash over the tracked columns."""
    return w.customer_v2.select("customer_id", change_hash(["customer_name", "customer_type"]).alias("change_hash"))


@query
def duplicate_line_keys(w):
    """Keys an upsert would refuse: order and line number repeat in the line table."""
    return duplicate_keys(w.sql(DIRTY_LINES), ["order_id", "line"])


@query
def overlapping_price_versions(w):
    """Both price lists as open-ended versions of the same products overlap; merged ones do not."""
    first = d.load_versions(None, w.product_v1, "dim_product", FIRST_DAY)
    second = d.load_versions(None, w.product_v2, "dim_product", REPRICED_ON).filter("product_id >= 0")
    both = first.unionByName(second).unionByName(w.build("dim_product").withColumn("product_id", -F.col("product_id") - 10))
    return overlapping_versions(both, "product_id").select("product_id", "effective_date", "next_effective_date")


@query
def scd2_customer_history(w):
    return w.build("dim_customer")


@query
def scd2_overwrite_untracked(w):
    first = d.load_versions(None, w.customer_v1, "dim_customer", FIRST_DAY)
    return d.load_versions(
        first, w.customer_v2, "dim_customer", REPRICED_ON, overwrite_untracked=True
    )


@query
def scd2_address_change(w):
    """History on other columns: HOUSEHOLD customers move one nation on."""
    home = w.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")).alias("address"),
    )
    moved = w.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(
            F.lit("nation "),
            (F.col("c_nationkey") + F.when(F.col("c_mktsegment") == "HOUSEHOLD", 1).otherwise(0)).cast("string"),
        ).alias("address"),
    )
    history = start_history(home, "customer_id", "customer_key", FIRST_DAY)
    return scd2_merge(history, moved, "customer_id", "customer_key", ["address"], REPRICED_ON)


# ---------------------------------------------------------------- facts


@query
def fact_order(w):
    return w.build("fact_order")


@query
def fact_order_header(w):
    return w.build("fact_order_header")


@query
def fact_product_daily(w):
    return w.build("fact_product_daily")


@query
def fact_seller_daily(w):
    return w.build("fact_seller_daily")


@query
def fact_order_daily(w):
    return w.build("fact_order_daily")


@query
def fact_inventory(w):
    return w.build("fact_inventory")


@query
def fact_customer_behavior(w):
    return w.build("fact_customer_behavior")


@query
def fact_product_daily_of_lines(w):
    """The product fact from stored order lines."""
    return f.product_daily_of(w.fact_order, w.dim_product)


def _silver_of(w: Warehouse) -> dict[str, DataFrame]:
    """All conformed tables from the raw tables, stored."""
    sources = {name for _, names in s.SILVER_TABLES.values() for name in names}
    silver = s.build_silver({name: w.raw(name) for name in sources})
    return {name: materialize(df, name) for name, df in silver.items()}


@query
def build_summary(w):
    """From raw tables to every stored dimension and fact, then rows per table."""
    silver = _silver_of(w)
    days = silver["sales_order_header"].agg(F.min("order_date"), F.max("order_date")).first()
    root = shared_folder(w.spark, "gold")
    return load_warehouse(silver, root, REPRICED_ON, AS_OF, calendar=tuple(days), loaded_at=F.lit(AS_OF))


def _screened(w: Warehouse):
    """Order lines as text, with quantities that are no numbers, negative amounts, missing and repeated keys."""
    raw = w.sql("""
SELECT CASE WHEN l_linenumber = 7 AND l_returnflag = 'A' THEN NULL ELSE concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) END AS line,
       CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), ' pcs') ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity,
       CASE WHEN l_quantity = 1 THEN '-1.00' ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END AS amount
FROM {lineitem}""")
    return screen(raw, ["line"], {"quantity": "int", "amount": "decimal(18,4)"}, ["amount"])


@query
def clean_rejects(w):
    """What cleaning of the order lines made NULL or dropped, with raw value and rule."""
    return _screened(w).rejects


@query
def clean_rejects_kept(w):
    """The lines that stayed."""
    return _screened(w).kept


# ---------------------------------------------------------------- incremental loads


@query
def load_state(w):
    """Marks after two loads, and what a table that was never loaded reads as."""
    header = w.order_header
    stamp = F.lit(AS_OF).cast("timestamp")
    before = inc.orders_mark(header.filter(F.col("order_date") < F.lit(CUT)), "fact_order")
    other = inc.orders_mark(header.filter(F.col("sales_channel") == "Online"), "fact_seller_daily")
    state = inc.advance_mark(empty_table(w.spark, "load_state"), before.unionByName(other), stamp)
    after = inc.orders_mark(header, "fact_order")
    state = inc.advance_mark(state, after, stamp)
    never = inc.load_mark(state, "fact_order_daily").select(
        F.lit("fact_order_daily").alias("table_name"), "last_loaded"
    )
    return state.drop("updated_at").unionByName(never, allowMissingColumns=True)


def _in_two_loads(w: Warehouse, build: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Load up to the mark, store the mark, then load what came since, a few days of it again."""
    header, detail = w.order_header, w.order_detail
    early = header.filter(F.col("order_date") < F.lit(CUT))
    mark = inc.orders_mark(early, "fact").withColumn("updated_at", F.lit(AS_OF).cast("timestamp"))
    state = conform(mark, "load_state")
    return inc.refresh_since(build(early, detail), header, detail, build, inc.read_mark(state, "fact"))


@query
def incremental_order_daily(w):
    return _in_two_loads(w, f.fact_order_daily)


@query
def incremental_product_daily(w):
    return _in_two_loads(w, lambda h, l: f.fact_product_daily(h, l, w.dim_product))


@query
def incremental_seller_daily(w):
    return _in_two_loads(w, lambda h, l: f.fact_seller_daily(h, l, w.dim_seller))


@query
def incremental_stored_runs(w):
    """Three runs over stored months and a stored mark: the early orders, all orders, nothing."""
    header, detail, root = w.order_header, w.order_detail, shared_folder(w.spark, "gold")
    early = header.filter(F.col("order_date") < F.lit(CUT))
    for known in [early, header, header.filter(F.col("order_date") < F.lit(FIRST_DAY))]:
        load_increment(known, detail, root, "fact_order_daily", f.fact_order_daily, lateness_days=3)
    return conform(read_table(w.spark, root, "fact_order_daily"), "fact_order_daily")


@query
def late_orders_order_daily(w):
    """A batch of back-dated orders: their days are recomputed in full."""
    header, detail = w.order_header, w.order_detail
    late = (F.col("status") == "P") & (F.col("order_date") < F.lit(CUT))
    known, batch = header.filter(~late), header.filter(late)
    stored = f.fact_order_daily(known, detail)
    return inc.refresh_days(stored, header, detail, inc.touched_days(batch), f.fact_order_daily)


@query
def details_of_orders(w):
    """Lines of the online orders only."""
    return inc.details_of(w.order_header.filter("sales_channel = 'Online'"), w.order_detail)


@query
def affected_customer_recompute(w):
    header, detail = w.order_header, w.order_detail
    early = header.filter(F.col("order_date") < F.lit(CUT))
    new = inc.orders_since(header, CUT)
    stored = f.fact_customer_behavior(early, detail, w.dim_customer, AS_OF)
    return inc.refresh_customers(stored, new, header, detail, w.dim_customer, AS_OF)


@query
def full_refresh_inventory(w):
    """Stock before and after a recount that leaves out location 3; its rows stay."""
    stored = w.fact_inventory
    recount = w.inventory.filter("location_id < 3").withColumn("quantity", F.col("quantity") + 5)
    return full_refresh(stored, f.fact_inventory(recount, w.dim_product), ["fact_inventory_key"])


@query
def full_refresh_inventory_delete(w):
    stored = w.fact_inventory
    recount = w.inventory.filter("location_id < 3").withColumn("quantity", F.col("quantity") + 5)
    fresh = f.fact_inventory(recount, w.dim_product)
    return full_refresh(stored, fresh, ["fact_inventory_key"], delete_missing=True)


@query
def replace_month_partitions(w):
    """Facts stored by month; a later load overwrites only the months it brings."""
    root = shared_folder(w.spark, "gold")
    header, detail = w.order_header, w.order_detail
    replace_months(f.fact_order_daily(header.filter("status <> 'P'"), detail), root, "fact_order_daily")
    since = inc.orders_since(header, CUT)
    replace_months(f.fact_order_daily(since, detail), root, "fact_order_daily")
    return conform(read_table(w.spark, root, "fact_order_daily"), "fact_order_daily")


@query
def late_orders_months(w):
    """Back-dated orders against a fact in month partitions: all days of their months."""
    header, detail = w.order_header, w.order_detail
    batch = header.filter((F.col("order_date") >= F.lit(CUT)) | (F.col("order_date") < F.lit(date(1996, 1, 15))))
    return inc.rebuild_months(header, detail, inc.months_of(batch), f.fact_order_daily)


@query
def late_orders_by_arrival(w):
    """Back-dated orders that arrive after the first load: the second finds them by arrival, whatever their date.

    Some orders were loaded with another date, which the second load corrects; some had no lines yet.
    """
    header, detail, root = w.order_header, w.order_detail, shared_folder(w.spark, "gold")
    late = (F.col("status") == "P") & (F.col("order_date") < F.lit(CUT))
    moved, bare = F.pmod(F.xxhash64("order_id"), F.lit(50)) == 1, F.pmod(F.xxhash64("order_id"), F.lit(50)) == 2
    arrived = F.when(late | moved, F.lit(datetime(2001, 8, 2))).otherwise(F.lit(datetime(2001, 8, 1)))
    stamped = header.withColumn("ingested_at", arrived.cast("timestamp"))
    wrong = F.when(moved, F.add_months("order_date", -2)).otherwise(F.col("order_date"))
    first = header.filter(~late).withColumns({"order_date": wrong, "ingested_at": F.lit(datetime(2001, 8, 1)).cast("timestamp")})
    for known, lines in [(first, detail.filter(~bare)), (stamped, detail)]:
        load_increment(known, lines, root, "fact_order_daily", f.fact_order_daily)
    return conform(read_table(w.spark, root, "fact_order_daily"), "fact_order_daily")


@query
def month_emptied(w):
    """A month that loses all its orders to other days leaves the fact, in an increment and in a full build."""
    header, detail, root = w.order_header, w.order_detail, shared_folder(w.spark, "gold")
    emptied = F.col("order_date").between(F.lit(date(1996, 2, 1)), F.lit(date(1996, 2, 29)))
    replace_months(f.fact_order_daily(header, detail), root, "fact_order_daily")
    left = header.filter(~emptied)
    fresh = inc.rebuild_months(left, detail, [199602, 199603], f.fact_order_daily)
    replace_months(fresh, root, "fact_order_daily", [199602, 199603])
    return conform(read_table(w.spark, root, "fact_order_daily"), "fact_order_daily")


def _in_increments(w: Warehouse) -> str:
    """All facts loaded twice: the early orders, then all; where they are stored."""
    place = (w.spark.sparkContext.applicationId, w.folder, "in increments")
    if place not in FOLDERS:
        root = shared_folder(w.spark, "gold")
        # each conformed table is stored once, with its month
        header = materialize(inc.with_month(w.build("order_header").join(w.order_address, "order_id")), "headers")
        silver = {
            "sales_order_header": header,
            "sales_order_detail": materialize(inc.lines_with_month(header, w.build("order_detail")), "lines"),
            "product_inventory": w.inventory,
        }
        dims = {name: getattr(w, name) for name in ("dim_product", "dim_customer", "dim_seller", "dim_geography")}
        early = silver | {"sales_order_header": header.filter(F.col("order_date") < F.lit(CUT))}
        load_facts(early, dims, root, AS_OF)
        add_facts(silver, dims, root, AS_OF)
        FOLDERS[place] = root
    return FOLDERS[place]


def _increments(table: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        w = Warehouse(configure(spark), folder)
        root = _in_increments(w)
        stored = read_version(w.spark, root, table) if table == "fact_customer_behavior" else read_table(w.spark, root, table)
        return conform(stored, table)

    return run


def _in_store(w: Warehouse) -> str:
    """All facts from an order store in two batches: orders and lines that are late, wrong or too many, then what puts them right."""
    place = (w.spark.sparkContext.applicationId, w.folder, "in store")
    if place not in FOLDERS:
        root, store = shared_folder(w.spark, "gold"), OrderStore(w.spark, shared_folder(w.spark, "store"), buckets=2)
        orders, lines = w.order_header.join(w.order_address, "order_id"), w.order_detail
        dims = {name: getattr(w, name) for name in ("dim_product", "dim_customer", "dim_seller", "dim_geography")}

        def some(key: str, one_in: int, of: int) -> Column:
            return F.pmod(F.xxhash64(key), F.lit(one_in)) == of

        recent = F.col("order_date") >= F.lit(date(2001, 1, 1))
        late, moved, bare = recent & some("order_id", 9, 0), recent & some("order_id", 9, 1), recent & some("order_id", 9, 2)
        wrong = F.when(moved, F.add_months("order_date", -1)).otherwise(F.col("order_date"))
        extra = orders.filter(recent & some("order_id", 40, 3)).withColumn("order_id", -F.col("order_id"))
        first = orders.filter(~late).withColumn("order_date", wrong).unionByName(extra)
        ids = orders.filter(bare | late).select("order_id")
        new = lines.join(orders.filter(recent).select("order_id"), "order_id", "left_semi")
        higher = F.when(some("order_detail_id", 9, 5), F.col("order_qty") + 1).otherwise(F.col("order_qty")).cast("int")
        more = new.filter(some("order_detail_id", 20, 7)).withColumn("order_detail_id", F.concat(F.lit("extra "), F.col("order_detail_id").cast("string")))
        of_extra = lines.join(extra.select((-F.col("order_id")).alias("order_id")), "order_id", "left_semi").withColumns(
            {"order_id": -F.col("order_id"), "order_detail_id": F.concat(F.lit("of extra "), F.col("order_detail_id").cast("string"))}
        )
        rest = lines.join(orders.filter(recent).select("order_id"), "order_id", "left_anti")
        known = rest.unionByName(new.join(ids, "order_id", "left_anti").withColumn("order_qty", higher)).unionByName(more).unionByName(of_extra)
        store.merge(first, known)
        load_stored_facts(store, dims, root, AS_OF)
        again = new.filter(some("order_detail_id", 9, 5)).unionByName(new.join(ids, "order_id", "left_semi")).distinct()
        store.merge(orders.filter(late | moved), again, extra.select("order_id"), more.select("order_id", "order_detail_id"))
        load_stored_facts(store, dims, root, AS_OF)
        FOLDERS[place] = root
    return FOLDERS[place]


def _from_store(table: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        w = Warehouse(configure(spark), folder)
        return stored_fact(w.spark, _in_store(w), table)

    return run


@query
def store_increment_months(w):
    """A day-grain fact that follows an order store: a first batch, a batch of late orders, and a run that finds nothing."""
    root, store = shared_folder(w.spark, "gold"), OrderStore(w.spark, shared_folder(w.spark, "store"), buckets=1)
    # repeats leave in the store's own shuffle by id: what a batch holds is not stored beforehand
    header, lines = w.build("order_header"), w.build("order_detail")
    late = F.col("order_date") >= F.lit(CUT)
    store.merge(header.filter(~late), lines)
    load_stored_increment(store, root, "fact_order_daily", f.fact_order_daily)
    store.merge(header.filter(late), lines.filter("false"))
    for _ in range(2):
        load_stored_increment(store, root, "fact_order_daily", f.fact_order_daily)
    return stored_fact(w.spark, root, "fact_order_daily")


INCREMENT_FACTS = [
    "fact_order", "fact_order_header", "fact_product_daily", "fact_seller_daily", "fact_order_daily", "fact_customer_behavior",
]
QUERIES |= {f"increments_{table}": _increments(table) for table in INCREMENT_FACTS}
QUERIES |= {f"store_{table}": _from_store(table) for table in INCREMENT_FACTS}


def _two_versions(w: Warehouse) -> dict[str, DataFrame]:
    """Facts loaded in two runs with a Type-2 change of customers and products between them.

    The first run knows the first versions only; its facts and its stock keep their keys.
    """
    header, detail = w.order_header.join(w.order_address, "order_id"), w.order_detail
    early, late = header.filter(F.col("order_date") < F.lit(CUT)), inc.orders_since(header, CUT)
    old_customers = d.load_versions(None, w.customer_v1, "dim_customer", FIRST_DAY)
    old_products = d.load_versions(None, w.product_v1, "dim_product", FIRST_DAY)
    first = f.fact_order(early, detail, old_customers, old_products, w.dim_geography, w.dim_seller)
    second = f.fact_order(late, detail, w.dim_customer, w.dim_product, w.dim_geography, w.dim_seller)
    sold = f.fact_product_daily(early, detail, old_products).unionByName(f.fact_product_daily(late, detail, w.dim_product))
    stored = f.fact_customer_behavior(early, detail, old_customers, AS_OF)
    return {
        "orders": f.fact_order_header(first).unionByName(f.fact_order_header(second)),
        "sold": sold,
        "stock": f.fact_inventory(w.inventory, old_products),
        "behavior": inc.refresh_customers(stored, late, header, detail, w.dim_customer, AS_OF),
    }


@query
def versions_top_regions(w):
    return a.top_regions(_two_versions(w)["orders"], w.dim_geography, w.dim_customer)


@query
def versions_seller_segments(w):
    facts = _two_versions(w)
    return a.seller_segments(facts["orders"], w.dim_seller, w.dim_customer, facts["behavior"], BEST_SELLER)


@query
def versions_stock_vs_sales(w):
    facts = _two_versions(w)
    return a.lowest_stocks(a.stock_and_sales(w.dim_product, facts["stock"], facts["sold"]))


@query
def versions_customer_behavior(w):
    """Lifetime rows carry the current version's key after a change of the customer."""
    return _two_versions(w)["behavior"]


# ---------------------------------------------------------------- reports


@query
def q_sales_kpis(w):
    return a.sales_kpis(w.fact_product_daily, w.fact_order_daily)


@query
def q_daily_trend(w):
    return a.daily_trend(w.fact_product_daily, w.dim_date)


@query
def q_aov_by_type(w):
    return a.order_value_by_type(w.fact_order_header, w.dim_customer)


@query
def q_top_products(w):
    return a.top_products(w.fact_product_daily, w.dim_product)


@query
def q_revenue_by_country(w):
    return a.revenue_by_country(w.fact_order_header, w.dim_geography)


@query
def q_revenue_by_type(w):
    return a.revenue_by_type(w.fact_order_header, w.dim_customer)


@query
def q_stock_vs_sales(w):
    stock = a.stock_and_sales(w.dim_product, w.fact_inventory, w.fact_product_daily)
    return a.lowest_stocks(stock)


@query
def q_low_stock(w):
    stock = a.stock_and_sales(w.dim_product, w.fact_inventory, w.fact_product_daily)
    return a.low_stock_alert(a.lowest_stocks(stock))


@query
def q_low_stock_all(w):
    return a.low_stock_alert(a.stock_and_sales(w.dim_product, w.fact_inventory, w.fact_product_daily))


@query
def q_segment_summary(w):
    return a.segment_summary(w.fact_customer_behavior)


@query
def q_top_regions(w):
    return a.top_regions(w.fact_order_header, w.dim_geography, w.dim_customer)


@query
def q_rfm_scatter(w):
    return a.rfm_scatter(w.fact_customer_behavior)


@query
def q_top_sellers(w):
    return a.top_sellers(w.fact_seller_daily, w.dim_seller)


@query
def q_seller_territories(w):
    return a.seller_territories(w.fact_order_header, w.dim_seller, w.dim_geography, BEST_SELLER)


@query
def q_seller_segments(w):
    return a.seller_segments(w.fact_order_header, w.dim_seller, w.dim_customer, w.fact_customer_behavior, BEST_SELLER)


@query
def q_category_by_country(w):
    return a.category_by_country(w.fact_order, w.dim_product, w.dim_geography)


@query
def q_seller_top_products(w):
    return a.seller_top_products(w.fact_order, w.dim_seller, w.dim_product, BEST_SELLER)


# ---------------------------------------------------------------- announced extras


@query
def x_kmeans_rfm(w):
    return customer_clusters(w.fact_customer_behavior)


@query
def x_kmeans_check(w):
    """Every customer once, clusters in range, and each customer nearest to its own cluster's centre."""
    customers, centres = clustered(w.fact_customer_behavior, k=4)
    return cluster_check(customers, centres, 4)


@query
def x_abc_class(w):
    return a.abc_classes(w.fact_product_daily, w.dim_product)


@query
def x_stream_incremental(w):
    """All orders as a stream of files, several batches; the fact equals a batch load."""
    root = shared_folder(w.spark, "stream")
    arrived = f"{root}/arrivals"
    w.order_header.repartition(4).write.parquet(arrived)
    orders = order_files(w.spark, arrived, w.order_header.schema, files_per_batch=2)
    start_load(orders, root, lambda: w.order_detail, "fact_order_daily", f.fact_order_daily).awaitTermination()
    return conform(read_table(w.spark, root, "fact_order_daily"), "fact_order_daily")


def _in_waves(header: DataFrame, detail: DataFrame) -> DataFrame:
    """Lines by ``wave``, stored: 0 for early finished orders, 1 for other online ones, 2 for the rest and lines without an order."""
    first = (F.col("order_date") < F.lit(CUT)) & (F.col("status") == "F")
    wave = F.when(first, 0).when(F.col("sales_channel") == "Online", 1).otherwise(2)
    waves = detail.join(header.select("order_id", wave.alias("wave")), "order_id", "left")
    return materialize(waves.select(*detail.columns, F.coalesce("wave", F.lit(2)).alias("wave")), "waves", ["wave"])


@query
def x_stream_late_lines(w):
    """Lines that arrive after their orders: some with a later batch, some after the last one."""
    root = shared_folder(w.spark, "stream")
    arrived, lines = f"{root}/arrivals", f"{root}/lines"
    # the lines are read once, to be dealt to their waves
    header, detail = w.order_header, w.build("order_detail")
    load = lambda: start_load(
        order_files(w.spark, arrived, header.schema), root, lambda: w.spark.read.parquet(lines), "fact_order_daily", f.fact_order_daily
    ).awaitTermination()
    early = F.col("order_date") < F.lit(CUT)
    waves = _in_waves(header, detail)
    first, rest, last = (waves.filter(F.col("wave") == k).drop("wave") for k in range(3))

    def arrive(df: DataFrame) -> None:
        df.write.mode("append").option("compression", "zstd").parquet(lines)

    arrive(first)
    header.filter(early).write.parquet(arrived)
    load()
    arrive(rest)
    header.filter(~early).write.mode("append").parquet(arrived)
    load()
    arrive(last)
    load_late_lines(w.spark, root, header.schema, last, lambda: w.spark.read.parquet(lines), "fact_order_daily", f.fact_order_daily)
    return conform(read_table(w.spark, root, "fact_order_daily"), "fact_order_daily")


@query
def x_stream_resent_orders(w):
    """Orders sent twice, first without their customer: the newest row counts, once."""
    root = shared_folder(w.spark, "stream")
    arrived, header = f"{root}/arrivals", w.order_header
    twice = header.filter("sales_channel = 'Online'")
    first = header.withColumn("customer_id", F.when(F.col("sales_channel") != "Online", F.col("customer_id")))
    for rows in (first, twice):
        rows.write.mode("append").parquet(arrived)
        orders = order_files(w.spark, arrived, header.schema)
        start_load(orders, root, lambda: w.order_detail, "fact_order_daily", f.fact_order_daily).awaitTermination()
    return conform(read_table(w.spark, root, "fact_order_daily"), "fact_order_daily")
