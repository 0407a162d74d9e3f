"""Whole-warehouse loads over stored tables: every dimension, every fact, and a summary.

The first load builds everything; later ones take the orders that came since and rebuild the months these
fall in. Sources that give only whole tables are loaded here; batches of arrivals go through ``order_store`` and
``stored_loads``, which never read history. Each layer is written before the next one reads it. A plan then starts from files whose sizes
Spark knows, nothing is computed twice, and a lost executor costs no more than its own tasks.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.keys import pack_keys, surrogate_key
from martwright.operators.merge import absent, full_refresh
from martwright.plans.dimensions import (
    dim_date_between,
    load_geography,
    load_vendor,
    load_versions,
)
from martwright.plans.facts import (
    fact_customer_behavior,
    fact_inventory,
    fact_order_daily,
    fact_seller_daily,
    keyed_orders,
    order_lines,
    order_totals,
    orders_of,
    product_daily_of,
)
from martwright.plans.incremental import (
    Build,
    advance_mark,
    arrived_since,
    current_behavior,
    details_of,
    load_mark,
    months_of,
    of_months,
    orders_mark,
    orders_since,
    read_arrival_mark,
    read_mark,
    rebuild_months,
    refresh_customers,
    with_month,
)
from martwright.schemas import HISTORY_START, conform, ddl, empty_table
from martwright.session import estimated_bytes, fitted_shuffles, materialize, scratch_tables
from martwright.sources.parquet import (
    by_month,
    clear_months,
    read_months,
    read_table,
    read_version,
    replace_all_months,
    replace_months,
    stored_months,
    table_exists,
    write_version,
)

# Facts stored by month; the others are stored as versions.
MONTHLY = ["fact_order", "fact_order_header", "fact_product_daily", "fact_seller_daily", "fact_order_daily"]
# Stored bytes of the lines whose months are built at once. The shuffles of a build take some ten times as much, and only
# those of one slice lie on disk together. Each slice costs its own plans, listings and commits, so small ones cost time.
SLICE = 256 * 1024**2
# A slice has so many months at most, and is written as its joins left it: a month's files are as many as the slice's tasks.
DIRECT = 8


def month_slices(months: list[int | None], size: int, most: int | None = None) -> list[list[int | None]]:
    """The months in as many runs as ``size`` bytes of lines ask for, none longer than ``most`` (else ``DIRECT``) if there are
    several; a month is never split."""
    asked = -(-size // SLICE)
    count = max(1, min(len(months), asked if asked < 2 else max(asked, -(-len(months) // (most or DIRECT)))))
    bounds = [len(months) * i // count for i in range(count + 1)]
    return [months[a:b] for a, b in zip(bounds, bounds[1:])]


def _stored(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    df = read_version(spark, root, table)
    return None if df is None else conform(df, table)


def _store(df: DataFrame, root: str, table: str, partition_by: list[str] | None = None) -> DataFrame:
    write_version(df, root, table, partition_by)
    return _stored(df.sparkSession, root, table)


def _monthly(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A fact stored by month, with its ``month_key``."""
    return read_table(spark, root, table, f"{ddl(table)}, month_key int")


def order_days(header: DataFrame) -> tuple[date, date] | None:
    """First and last order date, which a calendar has to cover; None without any date."""
    first, last = header.agg(F.min("order_date"), F.max("order_date")).first()
    return None if first is None else (first, last)


def calendar_for(header: DataFrame, calendar: tuple[date, date] | None) -> tuple[date, date] | None:
    """The given calendar, stretched to whole years of orders outside it, so that no fact day lacks its row."""
    days = order_days(header)
    if days is None:
        return calendar
    whole = (date(days[0].year, 1, 1), date(days[1].year, 12, 31))
    if calendar is None:
        return whole
    return (
        calendar[0] if calendar[0] <= days[0] else whole[0],
        calendar[1] if calendar[1] >= days[1] else whole[1],
    )


def load_dimensions(
    silver: dict[str, DataFrame],
    root: str,
    run_date: date,
    calendar: tuple[date, date] | None = None,
    loaded_at: Column | None = None,
) -> dict[str, DataFrame]:
    """Merge the conformed tables into the six stored dimensions; the first run creates them.

    Versioned dimensions are stored by ``is_current``: fact lookups that need only current
    rows read only those files. Without a ``calendar``, and beyond it, the days follow the orders.
    """
    spark = silver["product"].sparkSession
    span = calendar_for(silver["sales_order_header"], calendar)
    days = empty_table(spark, "dim_date") if span is None else dim_date_between(spark, *span)

    def versions(table: str, source: str) -> DataFrame:
        old = _stored(spark, root, table)
        new = load_versions(old, silver[source], table, HISTORY_START if old is None else run_date)
        return _store(new, root, table, ["is_current"])

    return {
        "dim_date": _store(days, root, "dim_date"),
        "dim_product": versions("dim_product", "product"),
        "dim_geography": _store(
            load_geography(_stored(spark, root, "dim_geography"), silver["geography"], loaded_at),
            root,
            "dim_geography",
        ),
        "dim_vendor": _store(
            load_vendor(_stored(spark, root, "dim_vendor"), silver["vendor"], loaded_at), root, "dim_vendor"
        ),
        "dim_customer": versions("dim_customer", "customer"),
        "dim_seller": versions("dim_seller", "seller"),
    }


def load_facts(
    silver: dict[str, DataFrame], dims: dict[str, DataFrame], root: str, as_of: date
) -> dict[str, DataFrame]:
    """Build and store all facts in full; months that have no rows any more are gone.

    The line table is shuffled for ``fact_order``, from which the order and product facts follow, and for the totals per
    order, from which the other three do. Long histories are stored by month first and built slice by slice, so that
    the shuffles on disk do not grow with them.
    """
    header, detail = silver["sales_order_header"], silver["sales_order_detail"]
    spark = header.sparkSession
    with scratch_tables(spark):
        return _load_facts(silver, header, detail, dims, root, as_of)


def _load_facts(silver, header: DataFrame, detail: DataFrame, dims: dict[str, DataFrame], root: str, as_of: date) -> dict[str, DataFrame]:
    line_mark = _line_mark(detail, "fact_order")
    totals = materialize(order_totals(detail), "order_totals")
    behavior = fact_customer_behavior(header, detail, dims["dim_customer"], as_of, totals)
    monthly = _store_months(lambda rows, table: replace_all_months(rows, root, table), header, detail, dims, root, totals)
    months = set(months_of(header))
    for table in MONTHLY:
        # what was built in slices has kept them
        clear_months(header.sparkSession, root, table, [m for m in stored_months(header.sparkSession, root, table) if m not in months])
    stored = _store_stock(silver, dims, root) | {"fact_customer_behavior": _store(behavior, root, "fact_customer_behavior")}
    _advance(header.sparkSession, header, root, line_mark=line_mark)
    return monthly | stored


def _store_months(
    store, header: DataFrame, detail: DataFrame, dims: dict[str, DataFrame], root: str, totals: DataFrame, months=None
) -> dict[str, DataFrame]:
    """Build the five facts that are stored by month, each from what is stored already where it can."""
    spark = header.sparkSession

    def chosen(table: str) -> DataFrame:
        rows = _monthly(spark, root, table)
        return conform(rows if months is None else of_months(rows, months), table)

    slices = month_slices(sorted(months_of(header) if months is None else months, key=str), estimated_bytes(detail))
    keyed = keyed_orders(header, *[dims[d] for d in ("dim_customer", "dim_geography", "dim_seller")])
    if len(slices) == 1:
        keyed = materialize(keyed, "keyed_orders")
        store(order_lines(keyed, detail, dims["dim_product"]), "fact_order")
        store(product_daily_of(chosen("fact_order"), dims["dim_product"]), "fact_product_daily")
    else:
        keyed = materialize(by_month(with_month(keyed)), "keyed_orders", ["month_key"])
        _store_slices(slices, keyed, detail, dims["dim_product"], root)
    store(orders_of(keyed, totals), "fact_order_header")
    store(fact_seller_daily(header, detail, dims["dim_seller"], totals), "fact_seller_daily")
    store(fact_order_daily(header, detail, totals), "fact_order_daily")
    return {table: conform(_monthly(spark, root, table), table) for table in MONTHLY}


def _store_slices(slices: list[list[int | None]], keyed: DataFrame, detail: DataFrame, dim_product: DataFrame, root: str) -> None:
    """The two facts that shuffle whole lines, slice by slice; each replaces its own months only.

    ``keyed`` headers are stored by month; the lines follow them, whatever month they were stored under.
    """
    spark = keyed.sparkSession
    days = keyed.select("order_id", "order_date", "month_key")
    lines = materialize(by_month(detail.drop("order_date", "month_key").join(days, "order_id")), "lines_by_month", ["month_key"])
    for months in slices:
        rows = order_lines(of_months(keyed, months), of_months(lines, months), dim_product)
        replace_months(rows, root, "fact_order", months, gather=False)
        sold = conform(read_months(spark, root, "fact_order", ddl("fact_order"), months), "fact_order")
        replace_months(product_daily_of(sold, dim_product), root, "fact_product_daily", months, gather=False)


def _store_stock(silver: dict[str, DataFrame], dims: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    stock = fact_inventory(silver["product_inventory"], dims["dim_product"])
    stored = _stored(stock.sparkSession, root, "fact_inventory")
    if stored is not None:
        stock = full_refresh(stored, stock, ["fact_inventory_key"])
    return {"fact_inventory": _store(stock, root, "fact_inventory")}


def _arrival(header: DataFrame) -> str:
    """The column that tells when an order came: its arrival where the source has it, else its date."""
    return "ingested_at" if "ingested_at" in header.columns else "order_date"


def _line_mark(detail: DataFrame, table: str, since: datetime | None = None) -> DataFrame | None:
    """Mark row of the lines that arrived after ``since``, stored before the lines are read; None without an arrival."""
    if "ingested_at" not in detail.columns:
        return None
    return materialize(orders_mark(arrived_since(detail, since), f"{table}/lines", "ingested_at"), "line_mark")


def _advance(
    spark: SparkSession, batch: DataFrame, root: str, tables: list[str] | None = None, line_mark: DataFrame | None = None
) -> None:
    """Move the marks of the facts, and that of their lines; a batch that looks back never moves one back."""
    stored = _stored(spark, root, "load_state")
    state = empty_table(spark, "load_state") if stored is None else stored
    names = tables or [*MONTHLY, "fact_customer_behavior"]
    # the batch is read once for all its marks
    marks = orders_mark(batch, names[0], _arrival(batch)).withColumn("table_name", F.explode(F.array(*[F.lit(n) for n in names])))
    marks = marks if line_mark is None else marks.unionByName(line_mark)
    before = state.groupBy("table_name").agg(F.max("last_loaded").alias("before"))
    marks = marks.join(before, "table_name", "left").withColumn("last_loaded", F.greatest("last_loaded", "before")).drop("before")
    write_version(materialize(advance_mark(state, marks), "load_state"), root, "load_state")


def new_orders(header: DataFrame, known: DataFrame) -> DataFrame:
    """Orders that the stored facts lack, without need of an arrival time."""
    return header.join(known.select("order_id"), "order_id", "left_anti")


def late_lines(
    header: DataFrame, detail: DataFrame, known: DataFrame, facts: DataFrame, mark: datetime | None, behind: DataFrame
) -> DataFrame:
    """Ids of orders with lines that the stored facts may lack; of those ``behind`` the batch, which is all that is asked for.

    Where lines carry ``ingested_at``: orders of lines that arrived after the line mark, and orders that have lines but
    are not stored. Without it, orders of lines that ``facts`` (stored lines) lacks, which reads the ids of all lines.
    """
    if "ingested_at" in detail.columns:
        unknown = details_of(new_orders(header, known), detail)
        return unknown.select("order_id").unionByName(arrived_since(detail, mark).select("order_id"))
    # an order whose lines have the same keys here and there lacks none; only lines of the others are looked up one by one
    ours = detail.select("order_id", surrogate_key("order_detail_id").alias("fact_order_key"))
    now, before = details_of(behind, _line_digests(ours)).alias("now"), _line_digests(facts).alias("before")
    same = F.lit(True)
    for c in ("lines", "digest", "total"):
        same = same & F.col(f"now.{c}").eqNullSafe(F.col(f"before.{c}"))
    other = now.join(before, F.col("now.order_id") == F.col("before.order_id"), "left").filter(~same).select("now.order_id")
    other = materialize(other, "other_lines")
    if other.isEmpty():
        return other
    keys = pack_keys(details_of(other, ours), ["fact_order_key"])
    return absent(pack_keys(facts.select("fact_order_key"), ["fact_order_key"]), keys, ["fact_order_key"]).select("order_id")


def _line_digests(lines: DataFrame) -> DataFrame:
    """Per order: how many lines, and two digests of their keys whatever their order (a pair of equal keys leaves the second)."""
    keys = lines.select("order_id", F.xxhash64("fact_order_key").alias("h"))
    return keys.groupBy("order_id").agg(
        F.count("*").alias("lines"), F.bit_xor("h").alias("digest"), F.sum(F.shiftright("h", 32)).alias("total")
    )


def add_facts(
    silver: dict[str, DataFrame], dims: dict[str, DataFrame], root: str, as_of: date
) -> dict[str, DataFrame]:
    """Bring all stored facts up to date with the orders that came since the last load. For sources without an order store
    (``stored_loads.load_stored_facts`` reads differing places only).

    Where headers carry ``ingested_at``, the batch is what arrived after the mark, back-dated and corrected
    orders included; without it, the orders that the facts lack. Orders whose lines came later than they did join
    it (``late_lines``). Its months, and those in which its orders were stored before, are rebuilt from their own
    orders and lines. Customers with a batch order get their lifetime row from all their orders; the others keep
    their sums.
    """
    with scratch_tables(silver["sales_order_header"].sparkSession):
        return _add_facts(silver, dims, root, as_of)


def _add_facts(silver: dict[str, DataFrame], dims: dict[str, DataFrame], root: str, as_of: date) -> dict[str, DataFrame]:
    header, detail = silver["sales_order_header"], silver["sales_order_detail"]
    spark = header.sparkSession
    known = _monthly(spark, root, "fact_order_header")
    state = _stored(spark, root, "load_state")
    since = read_arrival_mark(state, "fact_order/lines")
    line_mark = _line_mark(detail, "fact_order", since)
    if _arrival(header) == "ingested_at":
        mark = read_arrival_mark(state, "fact_order")
        batch, behind = arrived_since(header, mark), header.filter(F.col("ingested_at") <= F.lit(mark))
    else:
        batch, behind = new_orders(header, known), details_of(known, header)
    late = late_lines(header, detail, known, _monthly(spark, root, "fact_order"), since, behind)
    batch = materialize(batch.unionByName(details_of(late, behind)), "batch")
    dim_customer = dims["dim_customer"]
    stock = _store_stock(silver, dims, root)
    behavior = _stored(spark, root, "fact_customer_behavior")
    if batch.isEmpty():
        behavior = current_behavior(behavior, dim_customer, as_of)
    else:
        moved = details_of(batch, known).select("month_key").distinct().collect()
        # an order without lines makes no row: a month that only such orders join stays as it is
        sold = months_of(details_of(detail, batch))
        months = sorted({*sold, *(r["month_key"] for r in moved)}, key=str)
        if months:
            orders = materialize(of_months(header, months, "order_date"), "orders")
            lines = of_months(detail, months)
            totals = materialize(order_totals(details_of(orders, lines)), "order_totals")
            _store_months(lambda rows, table: replace_months(rows, root, table, months), orders, lines, dims, root, totals, months)
        behavior = refresh_customers(behavior, batch, header, detail, dim_customer, as_of)
    stored = {"fact_customer_behavior": _store(behavior, root, "fact_customer_behavior")} | stock
    if not batch.isEmpty():
        _advance(spark, batch, root, line_mark=line_mark)
    return {table: conform(_monthly(spark, root, table), table) for table in MONTHLY} | stored


LOADED = "order_id bigint, lines bigint, digest bigint, month_key int"


def loaded_orders(header: DataFrame, detail: DataFrame) -> DataFrame:
    """What a day-grain fact does not tell: its orders, their months, and count and digest of their lines."""
    whole = F.xxhash64(*[c for c in sorted(detail.columns) if c not in ("month_key", "ingested_at")])
    lines = detail.select("order_id", whole.alias("h")).groupBy("order_id").agg(F.count("*").alias("lines"), F.bit_xor("h").alias("digest"))
    orders = with_month(header.select("order_id", "order_date")).drop("order_date").join(lines, "order_id", "left")
    filled = orders.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("lines", "digest")})
    return filled.select("order_id", "lines", "digest", "month_key")


def load_increment(
    header: DataFrame,
    detail: DataFrame,
    root: str,
    table: str,
    build: Build,
    lateness_days: int = 0,
) -> bool:
    """Bring one stored day-grain fact up to date; False if there was nothing new. For sources without an order store: the
    lines of all orders are read and digested on every run (``stored_loads.load_stored_increment`` reads differing months only).

    Where headers carry ``ingested_at``, the batch is what arrived after the stored mark, so a back-dated order
    is found whatever its date; else it is the orders from the latest date loaded on (less ``lateness_days``).
    Orders whose month or lines differ from what was loaded join it. The months it touches, and those in which its
    orders were loaded before, are rebuilt in full and replaced, then what was loaded, then the mark. The first run
    takes all history, and so does one that finds a mark but not what was loaded. A run that dies in between is run again.
    """
    with scratch_tables(header.sparkSession):
        return _load_increment(header, detail, root, table, build, lateness_days)


def _load_increment(header: DataFrame, detail: DataFrame, root: str, table: str, build: Build, lateness_days: int) -> bool:
    spark = header.sparkSession
    stored_state = _stored(spark, root, "load_state")
    state = empty_table(spark, "load_state") if stored_state is None else stored_state
    if _arrival(header) == "ingested_at":
        new = arrived_since(header, read_arrival_mark(state, table))
    else:
        new = orders_since(header, read_mark(state, table), lateness_days)
    record = f"{table}_orders"
    if stored_state is None or load_mark(state, table).first()["last_loaded"] is None or not table_exists(spark, root, record):
        if header.isEmpty():
            return False
        with fitted_shuffles(header, detail):
            replace_all_months(build(header, detail), root, table)
            replace_all_months(loaded_orders(header, detail), root, record)
            _advance(spark, header, root, [table])
        return True
    with fitted_shuffles(header, detail):
        before = read_table(spark, root, record, LOADED)
        now = materialize(loaded_orders(header, detail), "orders_now")
        same = F.lit(True)
        for c in ("lines", "digest", "month_key"):
            same = same & F.col(f"now.{c}").eqNullSafe(F.col(f"before.{c}"))
        other = now.alias("now").join(before.alias("before"), (F.col("now.order_id") == F.col("before.order_id")) & same, "left_anti")
        ids = materialize(new.select("order_id").unionByName(other.select("order_id")).distinct(), "batch")
        if ids.isEmpty():
            return False
        batch = details_of(ids, now)
        touched = batch.select("month_key").unionByName(details_of(ids, before).select("month_key")).distinct()
        months = [r["month_key"] for r in touched.collect()]
        replace_months(rebuild_months(header, detail, months, build), root, table, months)
        replace_months(of_months(now, months), root, record, months)
        _advance(spark, new, root, [table])
    return True


def summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table in one job; an empty table counts as skipped."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    status = F.when(F.col("row_count") > 0, "loaded").otherwise("skipped")
    return reduce(DataFrame.unionByName, counts).withColumn("status", status)


def load_warehouse(
    silver: dict[str, DataFrame],
    root: str,
    run_date: date,
    as_of: date,
    calendar: tuple[date, date] | None = None,
    loaded_at: Column | None = None,
    full: bool = False,
) -> DataFrame:
    """All dimensions, then all facts; returns the rows per stored table.

    The first load, or a ``full`` one, builds every fact anew; any other adds what came since.
    """
    header = silver["sales_order_header"]
    with fitted_shuffles(header, silver["sales_order_detail"]):
        dims = load_dimensions(silver, root, run_date, calendar, loaded_at)
        first = _stored(header.sparkSession, root, "load_state") is None
        load = load_facts if full or first else add_facts
        return materialize(summary(dims | load(silver, dims, root, as_of)), "summary")
