"""The benchmark tables seen as the package's data model.

``star(spark, dir)`` maps them to fact and dimensions, ``wide`` gives the unsplit order
lines as the cleaning step leaves them, ``raw_orders`` the same lines as an untyped
extract with gaps, unreadable values and repeated rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cargolens.functions import derive
from cargolens.functions.text import standard_name
from cargolens.operators import star as model
from cargolens.operators.row_numbers import number_rows
from cargolens.operators.star import Star
from cargolens.schemas import FACT_COLUMNS, RAW_ORDER_FIELDS
from cargolens.sources import writers


# Declared, so that planning a scan does not first run a job to read file footers.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{path}/{name}.parquet")


# Columns are defined as functions and built only when asked for.
Columns = dict[str, Callable[[], Column]]


def pick(rows: DataFrame, columns: Sequence[str], *definitions: Columns) -> DataFrame:
    every = {name: make for d in definitions for name, make in d.items()}
    return rows.select(*[every[c]().alias(c) for c in columns])


# --- order lines ----------------------------------------------------------------

def _sales() -> Column:
    return F.col("l_extendedprice")


def _rate() -> Column:
    return F.col("l_discount")


def _margin() -> Column:
    # Whole hundredths first, so that 0.3 is the double nearest to 0.3.
    return (F.floor(F.col("l_tax") * 100 + 0.5) - 3) / F.lit(10.0)


def _discount() -> Column:
    return _sales() * _rate()


def _net() -> Column:
    return _sales() - _discount()


def _profit() -> Column:
    return _sales() * _margin()


# Columns that need nothing but lineitem.
LINE_COLUMNS: Columns = {
    "order_id": lambda: F.col("l_orderkey"),
    "order_item_id": lambda: F.col("l_suppkey") * 10 + F.col("l_linenumber"),
    "product_card_id": lambda: F.col("l_partkey"),
    "shipping_date_dateorders": lambda: F.col("l_shipdate"),
    "sales": _sales,
    "net_revenue": _net,
    "order_profit_per_order": _profit,
    "order_item_quantity": lambda: F.col("l_quantity").cast("int"),
    "order_item_discount": _discount,
    "order_item_discount_rate": _rate,
    "order_item_product_price": lambda: F.floor(_sales() / F.col("l_quantity")).cast("double"),
    "order_item_profit_ratio": _margin,
    "order_item_total": _net,
    "benefit_per_order": _profit,
    "sales_per_customer": _net,
    "profit_category": lambda: derive.profit_category(_margin()),
    "profit_tier": lambda: derive.profit_tier(_margin()),
    "discount_tier": lambda: derive.discount_tier(_rate()),
}


def _order_status() -> Column:
    pending = (F.when(F.col("o_orderpriority") == "5-LOW", "CANCELED")
               .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "PROCESSING")
               .otherwise("PENDING_PAYMENT"))
    return (F.when(F.col("o_orderstatus") == "F", "COMPLETE")
            .when(F.col("o_orderstatus") == "O", "SUSPECTED_FRAUD").otherwise(pending))


def _real_days() -> Column:
    return F.datediff(F.col("l_shipdate"), F.col("o_orderdate"))


def _scheduled_days() -> Column:
    return (F.when(F.col("o_orderpriority") == "1-URGENT", 1)
            .when(F.col("o_orderpriority") == "2-HIGH", 2)
            .when(F.col("o_orderpriority") == "3-MEDIUM", 4).otherwise(7))


def _delay() -> Column:
    return _real_days() - _scheduled_days()


# Fact columns that also need the order.
ORDER_LINE_COLUMNS: Columns = {
    "customer_id": lambda: F.col("o_custkey"),
    "order_date_dateorders": lambda: F.col("o_orderdate"),
    "days_for_shipping_real": _real_days,
    "days_for_shipment_scheduled": _scheduled_days,
    "shipping_delay_days": _delay,
    "shipping_performance": lambda: derive.shipping_performance(_delay()),
    "late_delivery_risk": lambda: F.when(_delay() > 0, 1).otherwise(0),
    "is_fraud": lambda: derive.fraud_label(_order_status()),
    "delivery_status": lambda: (F.when(_real_days() > 60, "Late delivery")
                                .when(_real_days() < 0, "Advance shipping")
                                .otherwise("Shipping on time")),
    **{name: (lambda name=name: derive.order_date_parts(F.col("o_orderdate"))[name])
       for name in ["order_year", "order_month", "order_month_name", "order_quarter",
                    "order_day_of_week", "order_week_number"]},
}


def lines(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Order lines; orders is joined only if one of its columns is wanted."""
    rows = table(spark, path, "lineitem")
    if any(c in ORDER_LINE_COLUMNS for c in columns):
        rows = rows.join(table(spark, path, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return pick(rows, columns, LINE_COLUMNS, ORDER_LINE_COLUMNS)


# --- dimensions -----------------------------------------------------------------

def _places(spark: SparkSession, path: str) -> DataFrame:
    return (table(spark, path, "customer")
            .join(table(spark, path, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(table(spark, path, "region"), F.col("n_regionkey") == F.col("r_regionkey")))


CUSTOMER: Columns = {
    "customer_id": lambda: F.col("c_custkey"),
    "customer_city": lambda: F.col("c_name"),
    "customer_country": lambda: F.col("n_name"),
    "customer_segment": lambda: F.col("c_mktsegment"),
    "customer_state": lambda: F.col("r_name"),
    "market": lambda: F.col("r_name"),
    "customer_full_location": lambda: derive.full_location(F.col("c_name"), F.col("n_name")),
}


def customers(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    rows = table(spark, path, "customer")
    if not set(columns) <= {"customer_id", "customer_city", "customer_segment"}:
        rows = _places(spark, path)
    return pick(rows, columns, CUSTOMER)


def _price() -> Column:
    return F.col("p_size") * F.lit(12.5)


PRODUCT: Columns = {
    "product_card_id": lambda: F.col("p_partkey"),
    "product_name": lambda: F.col("p_name"),
    "product_price": _price,
    "product_status": lambda: F.col("p_size") % 2,
    "category_id": lambda: F.length("p_type").cast("bigint"),
    "category_name": lambda: F.col("p_type"),
    "department_id": lambda: F.regexp_extract("p_brand", r"(\d+)$", 1).cast("bigint"),
    "department_name": lambda: F.col("p_brand"),
    "product_category_id": lambda: F.length("p_type").cast("bigint"),
    "stock_status": lambda: derive.stock_status(F.col("p_size") % 2),
    "price_range": lambda: derive.price_range(_price()),
}


def products(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return pick(table(spark, path, "part"), columns, PRODUCT)


ORDER: Columns = {
    "order_id": lambda: F.col("o_orderkey"),
    "order_status": _order_status,
    "order_region": lambda: F.col("r_name"),
    "order_country": lambda: F.col("n_name"),
    "order_city": lambda: F.col("c_name"),
    "order_state": lambda: F.col("r_name"),
    "shipping_mode": lambda: F.col("o_orderpriority"),
    "type": lambda: F.col("o_orderstatus"),
    "order_customer_id": lambda: F.col("o_custkey"),
    "status_group": lambda: derive.status_group(_order_status()),
}


# Row order of the lines inside a key: business keys first, then whatever tells lines apart.
LINE_ORDER = ["order_date_dateorders", "order_id", "order_item_id", "product_card_id",
              "shipping_date_dateorders", "sales"]


def orders(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Order dimension. The delivery status varies by line: the first line decides."""
    by_line = {"delivery_status", "delivery_risk_flag"} & set(columns)
    plain = [c for c in columns if c not in by_line]
    rows = table(spark, path, "orders")
    if set(plain) & {"order_region", "order_country", "order_city", "order_state"}:
        rows = rows.join(_places(spark, path), F.col("o_custkey") == F.col("c_custkey"))
    rows = pick(rows, plain, ORDER)
    if by_line:
        source = lines(spark, path, [*LINE_ORDER, "delivery_status"])
        first = model.first_row_per_key(source, "order_id", ["order_id", "delivery_status"],
                                        LINE_ORDER)
        first = first.withColumn("delivery_risk_flag",
                                 derive.delivery_risk_flag(F.col("delivery_status")))
        rows = rows.join(first, "order_id", "left")
    return rows.select(*columns)


def calendar(spark: SparkSession, path: str) -> DataFrame:
    return model.calendar(model.whole_years(table(spark, path, "orders"), "o_orderdate"))


def star(spark: SparkSession, path: str) -> Star:
    return Star(lambda cols: lines(spark, path, cols), {
        "customer": lambda cols: customers(spark, path, cols),
        "product": lambda cols: products(spark, path, cols),
        "order": lambda cols: orders(spark, path, cols),
        "date": lambda cols: calendar(spark, path).select(*cols),
    })


# --- unsplit lines and raw extracts ------------------------------------------------

WIDE: Columns = {**CUSTOMER, **PRODUCT, **ORDER, **LINE_COLUMNS, **ORDER_LINE_COLUMNS}


# What ``WIDE`` is derived from.
JOINED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
          "l_discount", "l_tax", "l_shipdate", "o_custkey", "o_orderstatus", "o_orderdate",
          "o_orderpriority", "c_name", "c_mktsegment", "n_name", "r_name", "p_name", "p_brand",
          "p_type", "p_size"]


def joined(spark: SparkSession, path: str) -> DataFrame:
    """Order lines with the columns of all their tables, before anything is derived.

    Lines are shuffled twice, for the part while they are narrow and for the order; the places
    meet the orders, of which there are fewer. Lines of an order lie together afterwards.
    """
    placed = table(spark, path, "orders").join(
        _places(spark, path), F.col("o_custkey") == F.col("c_custkey"))
    rows = (table(spark, path, "lineitem")
            .join(table(spark, path, "part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(placed, F.col("l_orderkey") == F.col("o_orderkey")))
    return rows.select(*JOINED)


def wide(spark: SparkSession, path: str, columns: Sequence[str] = tuple(WIDE)) -> DataFrame:
    """Unsplit order lines. Every attribute is joined, whatever the caller selects."""
    return pick(joined(spark, path), columns, WIDE)


def unsplit(rows: DataFrame) -> DataFrame:
    """``wide`` of stored ``joined`` rows."""
    return pick(rows, tuple(WIDE), WIDE)


def dealt_fact(rows: DataFrame) -> DataFrame:
    """Fact of stored ``joined`` rows, those of a month brought together (see ``write_table``) before
    the columns are derived: what can be computed afterwards isn't shuffled."""
    months = writers.PARTITIONS["fact_orders"]
    keyed = rows.withColumns({c: WIDE[c]() for c in months})
    return pick(keyed.hint("rebalance", *months), FACT_COLUMNS, WIDE)


LINE_BITS = 28  # of a row number, for the lines of one order


def numbered(spark: SparkSession, path: str, lines: DataFrame) -> DataFrame:
    """``lines`` with ``row_seq``, unique and ascending by order, item and product.

    Only the keys of the orders are sorted by range. The lines of an order lie together after the
    join that made them, so they are counted where they are and don't move for their numbers.
    """
    keys = table(spark, path, "orders").select(F.col("o_orderkey").alias("order_id")).distinct()
    keys = number_rows(keys.where("order_id is not null"), ["order_id"], "_order")
    within = Window.partitionBy("order_id").orderBy("order_item_id", "product_card_id")
    return (lines.withColumn("_place", F.row_number().over(within)).join(keys, "order_id")
            .withColumn("row_seq", F.shiftleft("_order", LINE_BITS) + F.col("_place"))
            .drop("_order", "_place"))


def raw_orders(spark: SparkSession, path: str, with_number: bool = False) -> DataFrame:
    """Order lines as an untyped extract under the raw headers, with planted dirt:

    * order date missing for 3-MEDIUM orders, unreadable for 2-HIGH ones,
    * sales missing where the tax is 0.08 and not a number where it is 0.07,
    * segment BUILDING missing, quantity written as "7.0" where the discount is 0.10,
    * lines with number 7 written twice.

    ``with_number`` adds ``row_seq`` in the order of order, item and product. The typed lines
    get it before they are turned into some fifty text columns.
    """
    lines = wide(spark, path)
    if with_number:
        lines = numbered(spark, path, lines)
    base = lines.withColumns({
        "latitude": F.lit(None).cast("string"), "longitude": F.lit(None).cast("string"),
        "customer_fname": F.col("customer_city"), "customer_lname": F.lit(None).cast("string"),
        "customer_email": F.lit("x@example.com"), "customer_password": F.lit("x"),
        "customer_street": F.col("customer_country"), "customer_zipcode": F.lit("00000"),
        "product_description": F.lit(None).cast("string"), "product_image": F.lit("none.png"),
        "order_item_cardprod_id": F.col("product_card_id"),
    })
    dirty = {
        "order_date_dateorders": (
            F.when(F.col("shipping_mode") == "3-MEDIUM", None)
            .when(F.col("shipping_mode") == "2-HIGH", "not a date")
            .otherwise(F.date_format("order_date_dateorders", "M/d/yyyy H:mm"))),
        "shipping_date_dateorders": F.date_format("shipping_date_dateorders",
                                                  "yyyy-MM-dd HH:mm:ss"),
        "sales": (F.when(F.col("order_item_profit_ratio") == 0.5, None)
                  .when(F.col("order_item_profit_ratio") == 0.4, "1d")
                  .otherwise(F.col("sales").cast("string"))),
        "customer_segment": F.when(F.col("customer_segment") != "BUILDING",
                                   F.col("customer_segment")),
        "order_item_quantity": F.concat(
            F.col("order_item_quantity").cast("string"),
            F.when(F.col("order_item_discount_rate") == 0.1, ".0").otherwise("")),
    }
    rows = base.select(*[
        dirty.get(standard_name(f), F.col(standard_name(f)).cast("string")).alias(f)
        for f in RAW_ORDER_FIELDS], (F.col("order_item_id") % 10).alias("_line"),
        *(["row_seq"] if with_number else []))
    copies = F.sequence(F.lit(0), F.when(F.col("_line") == 7, 1).otherwise(0))
    rows = rows.withColumn("_copy", F.explode(copies))
    if with_number:
        rows = rows.withColumn("row_seq", F.col("row_seq") * 2 + F.col("_copy"))
    return rows.drop("_line", "_copy")


def web(spark: SparkSession, path: str) -> DataFrame:
    """Web log under its raw headers, typed."""
    hit = table(spark, path, "events").join(
        table(spark, path, "part"), F.col("p_partkey") == F.col("user_id"))
    cart = F.when(F.col("event_type") == "purchase", "/add_to_cart").otherwise("")
    return hit.select(
        F.col("event_id"), F.col("p_name").alias("Product"), F.col("p_type").alias("Category"),
        F.col("ts").alias("Date"), F.date_format("ts", "MMM").alias("Month"),
        F.hour("ts").alias("Hour"), F.col("p_brand").alias("Department"),
        F.col("user_id").cast("string").alias("ip"),
        F.concat(F.lit("/department/"), F.col("p_type"), F.lit("/product/"), F.col("p_name"),
                 cart).alias("url"))
