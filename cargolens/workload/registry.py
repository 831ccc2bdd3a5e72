"""Every operator and report as a named query over the benchmark tables.

A query takes (spark, folder of the tables) and returns a DataFrame. DOUBLE results are
rounded here, and only here, so that they compare equal to the SQL of ``oracle``: the
order in which a cluster adds doubles shows in their last digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cargolens.functions.text import to_float, to_int, to_timestamp
from cargolens.operators import cleaning, conform, star as model
from cargolens.operators.dictionary import data_dictionary
from cargolens.operators.forward_fill import forward_fill
from cargolens.plans import (customers, findings, measures, operations, periods, pipeline, sales,
                             statistics, web)
from cargolens.schemas import FACT_COLUMNS, FIELD_TABLES, RAW_NUMERIC_FIELDS, WEBLOG_REQUIRED
from cargolens.session import own_dir, stage, tune
from cargolens.sources import readers, writers
from cargolens.workload import proxy

Query = Callable[[SparkSession, str], DataFrame]

# Decimal places by column; 6 for any other DOUBLE.
DIGITS = {
    "sales": 2, "revenue": 2, "total_sales": 2, "monetary": 2, "ly_sales": 2, "mtd_sales": 2,
    "qtd_sales": 2, "ytd_sales": 2, "rolling_sales": 2, "profit": 3, "total_profit": 3,
    "ly_profit": 3, "ytd_profit": 3, "total_revenue": 4,
}


# Money per order or customer often ends exactly in a half at the last place kept. The
# double just below or above it would decide, so such values are lifted first.
LIFTED = {"avg_order_value", "profit_per_customer", "sales_per_customer", "avg_profit", "mean"}


def rounded(df: DataFrame) -> DataFrame:
    doubles = [c for c, t in df.dtypes if t == "double"]
    if not doubles:
        return df
    return df.withColumns({c: F.round(F.col(c) + 1e-9 if c in LIFTED else c, DIGITS.get(c, 6))
                           for c in doubles})


# --- scans, cleaning and scalar functions over whole tables -----------------------

SCAN_COLUMNS = ["Order Id", "Order Item Id", "Customer Segment", "Product Name", "Sales",
                "order date (DateOrders)"]


def scan_orders(spark: SparkSession, path: str) -> DataFrame:
    """Write the raw extract as CSV, latin-1, and read it back."""
    target = own_dir(spark, "csv/orders")
    writers.write_extract(proxy.raw_orders(spark, path), target, encoding="ISO-8859-1")
    return readers.read_orders(spark, target).select(*[f"`{c}`" for c in SCAN_COLUMNS])


def scan_weblogs(spark: SparkSession, path: str) -> DataFrame:
    target = own_dir(spark, "csv/weblogs")
    fields = ["event_id", "Product", "Category", "Date", "Hour", "url"]
    hits = proxy.web(spark, path).withColumn("Date", F.date_format("Date", "yyyy-MM-dd HH:mm:ss"))
    hits.select(*fields).write.option("header", True).csv(target)
    return readers.read_weblogs(spark, target)


def drop_columns(spark: SparkSession, path: str) -> DataFrame:
    rows = proxy.raw_orders(spark, path).select(
        "`Order Id`", "`Order Item Id`", "`Customer Email`", "`Customer Street`",
        "`Product Image`", "`Order Region`")
    return cleaning.standardize_names(cleaning.drop_columns(rows))


def parse_ts(spark: SparkSession, path: str) -> DataFrame:
    text = F.concat_ws("", F.when(F.col("event_type") != "error", F.date_format(
        "ts", "M/d/yyyy H:mm")), F.when(F.col("event_type") == "error", F.lit("31/31/2024")))
    return proxy.table(spark, path, "events").select(
        "event_id", to_timestamp(text, cleaning.DATE_FORMATS).alias("parsed"))


def _repeated(spark: SparkSession, path: str) -> DataFrame:
    """Order lines, those with number 7 twice, segment missing for BUILDING."""
    return proxy.raw_orders(spark, path).select(
        F.col("Order Id").alias("order_id"), F.col("Order Item Id").alias("order_item_id"),
        F.col("Product Card Id").alias("product_card_id"),
        F.col("Customer Segment").alias("segment"))


def dedupe_rows(spark: SparkSession, path: str) -> DataFrame:
    return cleaning.dedupe_rows(_repeated(spark, path))


def _gaps(spark: SparkSession, path: str) -> DataFrame:
    return proxy.raw_orders(spark, path).select(
        "`Order Id`", "`Order Item Id`", "`Customer Segment`", "Sales")


def fill_numeric(spark: SparkSession, path: str) -> DataFrame:
    filled = cleaning.fill_missing(_gaps(spark, path), RAW_NUMERIC_FIELDS)
    return filled.select(F.col("Order Id").alias("order_id"),
                         F.col("Order Item Id").alias("order_item_id"),
                         F.when(F.col("Sales") == "1d", "1d").when(F.col("Sales") == "0", "0")
                         .otherwise("number").alias("sales_text"))


def fill_text(spark: SparkSession, path: str) -> DataFrame:
    filled = cleaning.fill_missing(_gaps(spark, path), RAW_NUMERIC_FIELDS)
    return filled.select(F.col("Order Id").alias("order_id"),
                         F.col("Order Item Id").alias("order_item_id"),
                         F.col("Customer Segment").alias("segment"))


def ffill_dates(spark: SparkSession, path: str) -> DataFrame:
    """Order dates in key order, missing for two of the five priorities."""
    gaps = proxy.table(spark, path, "orders").select(
        "o_orderkey", F.when(~F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM"),
                             F.col("o_orderdate")).alias("order_ts"))
    return forward_fill(gaps, ["order_ts"], "o_orderkey")


def std_names(spark: SparkSession, path: str) -> DataFrame:
    raw = proxy.raw_orders(spark, path).select(
        "`Order Id`", "`Order Item Id`", "`Days for shipping (real)`", "Late_delivery_risk")
    return cleaning.standardize_names(raw)


def coerce_int(spark: SparkSession, path: str) -> DataFrame:
    return proxy.raw_orders(spark, path).select(
        F.col("Order Id").alias("order_id"), F.col("Order Item Id").alias("order_item_id"),
        to_int(F.col("Order Item Quantity")).alias("quantity"),
        to_int(F.col("Sales")).alias("whole_sales"))


def coerce_float(spark: SparkSession, path: str) -> DataFrame:
    return proxy.raw_orders(spark, path).select(
        F.col("Order Id").alias("order_id"), F.col("Order Item Id").alias("order_item_id"),
        to_float(F.col("Sales")).alias("sales"),
        to_float(F.col("Order Item Discount Rate")).alias("rate"))


def drop_required_nulls(spark: SparkSession, path: str) -> DataFrame:
    hits = proxy.web(spark, path).withColumn(
        "Category", F.when(F.col("Category") != "PROMO", F.col("Category")))
    return cleaning.drop_incomplete(hits, WEBLOG_REQUIRED).select("event_id", "Category")


def nan_to_null(spark: SparkSession, path: str) -> DataFrame:
    rows = proxy.table(spark, path, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.lit(float("nan")))
        .otherwise(F.col("value")).alias("value"))
    return writers.nulls_for_nan(rows)


def line_query(*columns: str) -> Query:
    """Row-level fact columns of every line."""
    return lambda spark, path: rounded(proxy.star(spark, path).fact(
        ["order_id", "order_item_id", "product_card_id", *columns]))


def weblog_enrich(spark: SparkSession, path: str) -> DataFrame:
    return pipeline.clean_weblogs(proxy.web(spark, path)).select(
        "event_id", "year", "month_num", "day", "hour", "is_add_to_cart", "action_type",
        "hour_group")


WEB_HEAD_ROWS = 700  # fewer than any of the tables has, so the cut takes place


def weblog_head(spark: SparkSession, path: str) -> DataFrame:
    """The truncated sink: leading rows by time, the limit being the feature."""
    hits = pipeline.clean_weblogs(proxy.web(spark, path))
    return writers.first_rows(hits, ["date", "event_id"], WEB_HEAD_ROWS).select(
        "event_id", "date", "product", "is_add_to_cart")


# --- model ------------------------------------------------------------------------

def fact_orders(spark: SparkSession, path: str) -> DataFrame:
    return rounded(model.fact_orders(proxy.wide(spark, path)))


def dim_customer(spark: SparkSession, path: str) -> DataFrame:
    return model.dim_customer(proxy.wide(spark, path), proxy.LINE_ORDER)


def dim_product(spark: SparkSession, path: str) -> DataFrame:
    return model.dim_product(proxy.wide(spark, path), proxy.LINE_ORDER)


def dim_order(spark: SparkSession, path: str) -> DataFrame:
    return model.dim_order(proxy.wide(spark, path), proxy.LINE_ORDER)


def star_tables(lines: DataFrame, fact: DataFrame, spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {
        "fact_orders": fact,
        "dim_customer": model.dim_customer(lines, proxy.LINE_ORDER),
        "dim_product": model.dim_product(lines, proxy.LINE_ORDER),
        "dim_order": model.dim_order(lines, proxy.LINE_ORDER),
        "dim_date": proxy.calendar(spark, path),
        "fact_weblogs": pipeline.clean_weblogs(proxy.web(spark, path)).drop("event_id"),
    }


def row_counts(spark: SparkSession, path: str) -> DataFrame:
    return writers.table_counts(_stored_star(spark, path))


def _stored_star(spark: SparkSession, path: str, dealt: bool = False) -> dict[str, DataFrame]:
    """Star tables split off a stored copy of the lines, joined once instead of per table. What is
    derived isn't stored. ``dealt``: with the fact's rows brought together by month."""
    rows = stage(proxy.joined(spark, path), "joined", compression="zstd")
    lines = proxy.unsplit(rows)
    fact = proxy.dealt_fact(rows) if dealt else model.fact_orders(lines)
    return star_tables(lines, fact, spark, path)


def publish_star(spark: SparkSession, path: str) -> DataFrame:
    base = own_dir(spark, "star")
    stored = writers.publish_star(_stored_star(spark, path, dealt=True), base, dealt=["fact_orders"])
    return writers.table_counts(readers.read_star(spark, base, list(stored)))


def _published(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    base = own_dir(spark, "warehouse")
    writers.publish_warehouse(conform.conform(_stored_star(spark, path)), base)
    return writers.read_warehouse(spark, base)


def verify_counts(spark: SparkSession, path: str) -> DataFrame:
    return writers.table_counts(_published(spark, path))


def publish_warehouse(spark: SparkSession, path: str) -> DataFrame:
    """Sales by order year and product category, read back from the warehouse tables."""
    tables = _published(spark, path)
    return rounded(tables["Fact_Orders"].join(tables["Dim_Product"], "product_card_id")
                   .groupBy(F.year("Order_DateKey").alias("order_year"), "category_name")
                   .agg(F.sum("sales").alias("sales"), F.sum("Item_Quantity").alias("units")))


def conform_fact(spark: SparkSession, path: str) -> DataFrame:
    return rounded(conform.conform_fact(proxy.star(spark, path).fact([
        "order_id", "order_item_id", "product_card_id", "order_date_dateorders",
        "shipping_date_dateorders", "order_profit_per_order", "order_item_quantity",
        "days_for_shipping_real", "days_for_shipment_scheduled"])))


def conform_weblogs(spark: SparkSession, path: str) -> DataFrame:
    return conform.conform_weblogs(pipeline.clean_weblogs(proxy.web(spark, path))).select(
        "event_id", "Product_Name", "Category_Name", "IP_Address", "Log_Date", "Log_Year",
        "Log_Month_Num", "Log_Day", "Log_Hour", "action_type")


def conform_order(spark: SparkSession, path: str) -> DataFrame:
    return conform.conform_order(dim_order(spark, path)).select(
        "order_id", "Transaction_Type", "order_status", "status_group", "shipping_mode")


def conform_product(spark: SparkSession, path: str) -> DataFrame:
    return conform.conform_product(dim_product(spark, path))


def conform_date(spark: SparkSession, path: str) -> DataFrame:
    return conform.conform_date(proxy.calendar(spark, path)).select("DateKey", "year_month")


def raw_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """A dictionary extract with one row per part: known field names for most parts, the
    part's name for the others, with the stray blanks and colons of such files."""
    names = F.array(*[F.lit(name) for name, _ in FIELD_TABLES])
    slot = F.length("p_name") + F.col("p_size")
    field = F.when(slot <= len(FIELD_TABLES), names[slot - 1]).otherwise(F.col("p_name"))
    return proxy.table(spark, path, "part").select(
        F.concat(F.lit("  "), field, F.lit(" ")).alias("Field"),
        F.concat(F.lit(" : "), F.col("p_type"), F.lit(" of "), F.col("p_brand"), F.lit(" "))
        .alias("Description"))


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    return data_dictionary(raw_dictionary(spark, path))


def star_join(spark: SparkSession, path: str) -> DataFrame:
    return rounded(proxy.star(spark, path).lines([
        "order_id", "order_item_id", "product_card_id", "customer_id", "sales", "shipping_mode",
        "order_country", "customer_segment", "market", "product_name", "year_month"]))


# --- the cleaning pipeline on the dirty extract --------------------------------------

def clean_orders(spark: SparkSession, path: str) -> DataFrame:
    return rounded(model.fact_orders(pipeline.clean_orders(proxy.raw_orders(spark, path, with_number=True))))


def clean_star(spark: SparkSession, path: str) -> DataFrame:
    """Customer dimension of the cleaned extract: the first row in file order decides."""
    clean = pipeline.clean_orders(proxy.raw_orders(spark, path, with_number=True))
    # Its rows are stored before the last join, so that a table reads the columns it has.
    tables = pipeline.build_star(clean, first_day="1995-01-01", last_day="2001-12-31")
    return tables["dim_customer"].select("customer_id", "customer_segment", "market",
                                         "customer_full_location")


def dq_report(spark: SparkSession, path: str) -> DataFrame:
    return pipeline.quality_report(proxy.raw_orders(spark, path, with_number=True))


# --- reports ------------------------------------------------------------------------

def report(plan: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, path: rounded(plan(proxy.star(spark, path), *args))


def _hits(spark: SparkSession, path: str) -> DataFrame:
    return pipeline.clean_weblogs(proxy.web(spark, path))


def web_report(plan: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, path: rounded(plan(_hits(spark, path), *args))


def web_and_star(plan: Callable[..., DataFrame]) -> Query:
    return lambda spark, path: rounded(plan(_hits(spark, path), proxy.star(spark, path)))


QUERIES: dict[str, Query] = {
    "scan_orders": scan_orders,
    "scan_weblogs": scan_weblogs,
    "publish_star": publish_star,
    "publish_warehouse": publish_warehouse,
    "verify_counts": verify_counts,
    "weblog_head": weblog_head,
    "nan_to_null": nan_to_null,
    "drop_columns": drop_columns,
    "parse_ts": parse_ts,
    "dedupe_rows": dedupe_rows,
    "fill_numeric": fill_numeric,
    "fill_text": fill_text,
    "ffill_dates": ffill_dates,
    "std_names": std_names,
    "coerce_int": coerce_int,
    "coerce_float": coerce_float,
    "drop_required_nulls": drop_required_nulls,
    "dq_report": dq_report,
    "clean_orders": clean_orders,
    "clean_star": clean_star,
    "order_date_parts": line_query("order_year", "order_month", "order_month_name",
                                   "order_quarter", "order_day_of_week", "order_week_number"),
    "shipping_performance": line_query("shipping_delay_days", "shipping_performance"),
    "fraud_flag": line_query("is_fraud"),
    "profit_tiers": line_query("profit_category", "profit_tier"),
    "discount_tier": line_query("discount_tier"),
    "discount_band": line_query("discount_band"),
    "net_revenue": line_query("net_revenue"),
    "weblog_enrich": weblog_enrich,
    "fact_orders": fact_orders,
    "dim_customer": dim_customer,
    "dim_product": dim_product,
    "dim_order": dim_order,
    "dim_date": proxy.calendar,
    "conform_fact": conform_fact,
    "conform_weblogs": conform_weblogs,
    "conform_order": conform_order,
    "conform_product": conform_product,
    "conform_date": conform_date,
    "data_dictionary": dictionary,
    "star_join": star_join,
    "row_counts": row_counts,
    "kpi_headline": report(sales.kpi_headline),
    "monthly_trend": report(sales.monthly_trend),
    "yearly_performance": report(sales.yearly_performance),
    "market_performance": report(sales.market_performance),
    "segment_analysis": report(sales.segment_analysis),
    "rfm_base": report(customers.rfm_base),
    "rfm_scores": report(customers.rfm_scores),
    "rfm_segments": report(customers.rfm_segments),
    "product_performance": report(sales.product_performance),
    "top_products_sales": report(sales.top_products, "sales"),
    "top_products_profit": report(sales.top_products, "profit"),
    "department_performance": report(sales.department_performance),
    "discount_band_profit": report(sales.discount_band_profit),
    "late_overall": report(operations.late_overall),
    "shipping_mode_performance": report(operations.shipping_mode_performance),
    "delivery_status_mix": report(operations.delivery_status_mix),
    "region_late_rate": report(operations.region_late_rate),
    "fraud_summary": report(operations.fraud_summary),
    "fraud_by_market": report(operations.fraud_by_market),
    "fraud_by_mode": report(operations.fraud_by_mode),
    "country_performance": report(sales.country_performance),
    "top_countries": report(sales.top_countries),
    "web_totals": web_report(web.web_totals),
    "top_viewed_products": web_report(web.top_viewed, "product"),
    "top_viewed_categories": web_report(web.top_viewed, "category"),
    "web_hourly": web_report(web.web_hourly),
    "cart_conversion": web_report(web.cart_conversion),
    "views_vs_sales": web_and_star(web.views_vs_sales),
    "views_sales_corr": web_and_star(web.views_sales_corr),
    "correlation_matrix": report(statistics.correlation_matrix),
    "hist_sales": report(statistics.histogram, "sales"),
    "hist_profit": report(statistics.histogram, "order_profit_per_order"),
    "hist_delay": report(statistics.histogram, "shipping_delay_days"),
    "describe_fact": report(statistics.describe_fact, FACT_COLUMNS),
    "key_findings": report(findings.key_findings),
    "measures_total": report(measures.measures),
    "measures_by_market": report(measures.measures, ["market"]),
    "measures_by_month": report(measures.measures, ["year_month"]),
    "ly_sales": report(periods.last_year),
    "yoy_growth": report(periods.growth),
    "yoy_growth_by_year": report(periods.growth, (), "year"),
    "ytd_profit": report(periods.to_date, "year", (), "profit"),
    "mtd_sales": report(periods.to_date, "month"),
    "qtd_sales": report(periods.to_date, "quarter"),
    "ytd_sales": report(periods.to_date, "year"),
    "ytd_sales_by_market": report(periods.to_date, "year", ["market"]),
    "rolling_3m_sales": report(periods.rolling_days),
    "rolling_3m_by_month": report(periods.rolling_months),
}
