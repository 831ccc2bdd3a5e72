"""Queries over stored layouts: bucketed tables, daily bitmaps and sketches, the manifest, numbered
rows. Each one writes its layout from the benchmark tables and answers from there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cargolens.operators import cleaning, conform, star as model
from cargolens.operators.dictionary import data_dictionary
from cargolens.operators.first_row import first_row_per_key
from cargolens.operators.pruning import on_days
from cargolens.plans import operations, pipeline, reach, spans
from cargolens.schemas import FLOAT_COLUMNS, INFERRED_INT_COLUMNS, INT_COLUMNS, RAW_NUMERIC_FIELDS
from cargolens.session import own_dir, stage
from cargolens.sources import bucketed, readers, refresh, writers
from cargolens.workload import proxy
from cargolens.workload.registry import raw_dictionary, rounded

Query = Callable[[SparkSession, str], DataFrame]


# --- first rows by number ---------------------------------------------------------

# Attributes that differ from line to line, so that a wrong line of a key shows.
BY_LINE = {
    "market": lambda: F.concat_ws("/", "market", F.col("order_item_id") % 10),
    "customer_city": lambda: F.concat_ws("/", "customer_city", "order_item_quantity"),
    "product_price": lambda: F.col("product_price") + F.col("order_item_quantity"),
    "order_region": lambda: F.concat_ws("/", "order_region", F.col("order_item_id") % 10),
    "shipping_mode": lambda: F.concat_ws("/", "shipping_mode", "order_item_quantity"),
}


def numbered_lines(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Stored lines with ``row_seq``, ascending in the order of lines."""
    needed = list(dict.fromkeys([*proxy.LINE_ORDER, *columns]))
    rows = stage(proxy.wide(spark, path, needed), "lines")     # sorting reads them twice
    return stage(readers.with_row_seq(rows, proxy.LINE_ORDER), "numbered-lines")


def first_rows(key: str, *columns: str) -> Query:
    def run(spark: SparkSession, path: str) -> DataFrame:
        rows = numbered_lines(spark, path, [key, *columns, "order_item_quantity"])
        varied = rows.withColumns({c: BY_LINE[c]() for c in columns if c in BY_LINE})
        return first_row_per_key(varied, key, [key, *columns], "row_seq")
    return run


# --- equality by value ------------------------------------------------------------

def dedupe_by_value(spark: SparkSession, path: str) -> DataFrame:
    """Lines that come twice, the second time with a quantity of other spelling: ``7.0`` for ``7``."""
    rows = proxy.raw_orders(spark, path, with_number=True)
    spelled = F.when(F.col("row_seq") % 2 == 1, F.concat(F.lit("+0"), "`Order Item Quantity`", F.when(
        F.instr("`Order Item Quantity`", ".") == 0, ".00").otherwise("0")))
    rows = rows.withColumn("Order Item Quantity", F.coalesce(spelled, "`Order Item Quantity`"))
    rows = rows.select("`Order Id`", "`Order Item Id`", "`Product Card Id`", "`Order Item Quantity`")
    return cleaning.standardize_names(cleaning.dedupe_rows(cleaning.canonical_numbers(rows), copies="copies"))


# --- extracts as files ------------------------------------------------------------

def dictionary_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """The dictionary written as CSV under other headers and read by position."""
    target = own_dir(spark, "csv/dictionary")
    (raw_dictionary(spark, path).toDF("FIELDS", "What it is").write.option("header", True)
     .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(target))
    return data_dictionary(readers.read_dictionary(spark, target))


def odd_headers(spark: SparkSession, path: str) -> DataFrame:
    """An extract whose columns come in another order, without two of the known ones and with a note
    that holds commas, quotes and line breaks; cleaned, and derived as far as its columns allow."""
    target = own_dir(spark, "csv/odd")
    note = F.concat(F.lit('he said: "'), "`Customer City`", F.lit('",\nthen\n'), "`Order Id`")
    rows = proxy.raw_orders(spark, path).withColumn(" Order  Note ", note)
    rows = rows.drop("Days for shipping (real)", "Sales").select(
        "` Order  Note `", *[f"`{c}`" for c in reversed(rows.columns)
                             if c not in ("Days for shipping (real)", "Sales", " Order  Note ")])
    writers.write_extract(rows, target, encoding="ISO-8859-1", escape='"')
    read = readers.read_orders(spark, target, multi_line=True)
    clean = cleaning.standardize_names(cleaning.fill_missing(cleaning.drop_columns(read), RAW_NUMERIC_FIELDS))
    typed = pipeline.derive_orders(cleaning.coerce_numbers(clean, INT_COLUMNS + INFERRED_INT_COLUMNS, FLOAT_COLUMNS))
    # What needs an absent column isn't there, and asking for it is no error.
    wanted = ["order_id", "order_item_id", "product_card_id", "order_note", "customer_segment", "profit_tier",
              "discount_tier", "is_fraud", "sales", "net_revenue", "shipping_performance", "customer_email"]
    return typed.select(cleaning.present(typed, wanted))


# --- buckets ----------------------------------------------------------------------

ORDER_FACT = ["order_id", "order_item_id", "product_card_id", "sales", "late_delivery_risk",
              "shipping_delay_days"]
ORDER_ATTRIBUTES = ["order_id", "shipping_mode", "order_country", "status_group"]


def order_star(spark: SparkSession, path: str) -> bucketed.BucketedStar:
    source, base = proxy.star(spark, path), own_dir(spark, "bucketed")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    layouts = bucketed.write_star({"fact": source.fact(ORDER_FACT),
                                   "order": source.dimension("order", ORDER_ATTRIBUTES[1:])}, base, buckets)
    return bucketed.BucketedStar.read(spark, base, layouts)


def bucketed_order_join(spark: SparkSession, path: str) -> DataFrame:
    star = order_star(spark, path)
    return bucketed.join_in_place(
        star.fact(["order_id", "order_item_id", "product_card_id", "sales"]),
        star.dimension("order", ORDER_ATTRIBUTES[1:]), "order_id")


def bucketed_shipping_mode(spark: SparkSession, path: str) -> DataFrame:
    return rounded(operations.shipping_mode_performance(order_star(spark, path)))


# --- pruning by the calendar ------------------------------------------------------

def quarter_of_partitions(spark: SparkSession, path: str, quarter: str = "FY1997-Q2") -> DataFrame:
    """Sales of a fiscal quarter by month, from the fact stored by year and month."""
    base = own_dir(spark, "partitioned")
    fact = proxy.star(spark, path).fact(["order_id", "order_date_dateorders", "sales", "order_item_quantity",
                                         "order_year", "order_month"])
    stored = writers.publish_star({"fact_orders": fact}, base)["fact_orders"]
    days = proxy.calendar(spark, path).where(F.col("fiscal_quarter") == quarter)
    rows = on_days(spark.read.schema(fact.schema).parquet(stored), days)
    return rounded(rows.groupBy("order_year", "order_month").agg(
        F.count("*").alias("lines"), F.sum("sales").alias("sales")))


# --- spans of days ----------------------------------------------------------------

def span(groups: tuple[str, ...] = (), **choice) -> Query:
    def run(spark: SparkSession, path: str) -> DataFrame:
        return rounded(spans.over_days(spans.daily_summary(proxy.star(spark, path), groups), **choice))
    return run


def web_reach(spark: SparkSession, path: str) -> DataFrame:
    """Hits by hour of the day, and whether the estimates from the stored hours lie within three
    standard errors of the exact count and equal those of one sketch over all hits of the group."""
    hits = pipeline.clean_weblogs(proxy.web(spark, path))
    stored = reach.hourly_reach(hits, "product")
    merged = reach.reach(stored, [F.hour("hour_start").alias("hour")])
    direct = hits.where("date is not null").groupBy(F.hour("date").alias("hour")).agg(
        F.countDistinct("product").alias("products"))
    sketched = hits.where("date is not null").groupBy(F.hour("date").alias("hour")).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("product", reach.LG_K)).alias("at_once"))
    off = F.abs(F.col("distinct_estimate") - F.col("products"))
    return merged.join(direct, "hour").join(sketched, "hour").select(
        "hour", "hits", "products", (off <= 3 * reach.standard_error() * F.col("products")).alias("within_error"),
        # A sketch that has seen rows in another order may estimate a few off by rounding.
        (F.abs(F.col("distinct_estimate") - F.col("at_once")) <= 1 + 0.001 * F.col("products")).alias("merges"))


# --- refresh ----------------------------------------------------------------------

def refresh_warehouse(spark: SparkSession, path: str) -> DataFrame:
    """Two refreshes, the second with the orders of the last status changed; rows of the current
    tables beside what the manifest says of them."""
    base = own_dir(spark, "refreshed")
    lines = stage(proxy.joined(spark, path), "joined", compression="zstd")
    tables = conform.conform({
        "fact_orders": proxy.dealt_fact(lines),
        "dim_customer": proxy.customers(spark, path, list(proxy.CUSTOMER)),
        "dim_product": proxy.products(spark, path, list(proxy.PRODUCT)),
        "dim_order": proxy.orders(spark, path, list(proxy.ORDER)),
        "dim_date": proxy.calendar(spark, path)})
    refresh.refresh(tables, base, dealt=["Fact_Orders"])
    changed = tables["Dim_Order"].withColumn("shipping_mode", F.upper("shipping_mode"))
    entry = refresh.refresh({**tables, "Dim_Order": changed}, base, dealt=["Fact_Orders"])
    counts = writers.table_counts(refresh.read_current(spark, base))
    return counts.join(entry.select("table_name", F.col("row_count").alias("manifest_rows"), "version"),
                       "table_name")


QUERIES: dict[str, Query] = {
    "first_customer": first_rows("customer_id", "market", "customer_city", "customer_segment"),
    "first_product": first_rows("product_card_id", "product_price", "product_name"),
    "first_order": first_rows("order_id", "order_region", "shipping_mode", "delivery_status"),
    "dedupe_by_value": dedupe_by_value,
    "dictionary_from_csv": dictionary_from_csv,
    "odd_headers": odd_headers,
    "bucketed_order_join": bucketed_order_join,
    "bucketed_shipping_mode": bucketed_shipping_mode,
    "quarter_of_partitions": quarter_of_partitions,
    "span_total": span(),
    "span_by_market": span(("market",), first="1996-03-15", last="1998-10-02"),
    "span_by_market_year": span(("market",), grain="year"),
    "span_by_market_of_segments": span(("market", "customer_segment"), by=["market"]),
    "web_reach": web_reach,
    "refresh_warehouse": refresh_warehouse,
}
