"""Star tables under the warehouse's column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cargolens.schemas import WAREHOUSE_FACT_NAMES, WAREHOUSE_WEBLOG_NAMES


def conform_date(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"date": "DateKey"}).withColumn(
        "DateKey", F.col("DateKey").cast("date"))


def conform_customer(df: DataFrame) -> DataFrame:
    return df


def conform_product(df: DataFrame) -> DataFrame:
    return df.drop("product_category_id")


def conform_order(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"type": "Transaction_Type"}).drop("order_customer_id")


def conform_fact(df: DataFrame) -> DataFrame:
    """Timestamps are cut to days here; the star tables keep the time of day."""
    days = ["Order_DateKey", "Shipping_DateKey"]
    return df.withColumnsRenamed(WAREHOUSE_FACT_NAMES).withColumns(
        {c: F.col(c).cast("date") for c in days})


def conform_weblogs(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(WAREHOUSE_WEBLOG_NAMES).drop("month")   # in any case of letters


def conform(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Star table names -> warehouse tables."""
    rules = {
        "dim_date": ("Dim_Date", conform_date),
        "dim_customer": ("Dim_Customer", conform_customer),
        "dim_product": ("Dim_Product", conform_product),
        "dim_order": ("Dim_Order", conform_order),
        "fact_orders": ("Fact_Orders", conform_fact),
        "fact_weblogs": ("Fact_WebLogs", conform_weblogs),
    }
    return {rules[name][0]: rules[name][1](df) for name, df in tables.items() if name in rules}
