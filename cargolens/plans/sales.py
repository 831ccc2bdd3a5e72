"""Sales, market, product and discount reports over a ``Star``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cargolens.functions import derive
from cargolens.functions.numbers import percent, ratio
from cargolens.operators.star import Star

MONEY = {"sales": "sales", "profit": "order_profit_per_order"}
UNITS = {**MONEY, "units": "order_item_quantity"}
ORDERS = {"orders": "order_id"}


def margin_pct() -> Column:
    return percent("profit", "sales").alias("margin_pct")


def total(column: str) -> Column:
    """Grand total over the rows of a finished report.

    Only for reports with one row per category: the window takes them all in one task. A
    separate total would scan the fact a second time.
    """
    return F.sum(column).over(Window.partitionBy())


def kpi_headline(star: Star) -> DataFrame:
    kpi = star.aggregate(sums=MONEY, distinct=ORDERS).withColumns({
        "avg_order_value": ratio("sales", "orders"), "margin_pct": margin_pct()})
    return kpi.select(
        F.col("sales").alias("total_sales"), F.col("profit").alias("total_profit"),
        F.col("orders").alias("total_orders"), "avg_order_value", "margin_pct",
        F.round(F.col("sales") / 1e6, 2).alias("sales_m"),
        F.round(F.col("profit") / 1e6, 2).alias("profit_m"),
        F.round(F.col("orders") / 1e3, 1).alias("orders_k"),
        F.round("avg_order_value", 2).alias("avg_order_value_rounded"),
        F.round("margin_pct", 2).alias("margin_pct_rounded"))


def monthly_trend(star: Star) -> DataFrame:
    return (star.aggregate(["year_month"], MONEY)
            .select("year_month", "sales", "profit").orderBy("year_month"))


def yearly_performance(star: Star) -> DataFrame:
    return (star.aggregate(["year"], MONEY).withColumn("margin_pct", margin_pct())
            .select("year", "sales", "profit", "margin_pct").orderBy("year"))


def market_performance(star: Star) -> DataFrame:
    return (star.aggregate(["market"], MONEY, distinct=ORDERS).withColumn("margin_pct", margin_pct())
            .select("market", "sales", "profit", "orders", "margin_pct",
                    derive.above(F.col("margin_pct"), 10).alias("status"))
            .orderBy("sales", "market"))


def segment_analysis(star: Star) -> DataFrame:
    seg = star.aggregate(["customer_segment"], {"sales": "sales"},
                         distinct={**ORDERS, "customers": "customer_id"})
    return seg.select(
        "customer_segment", "sales", "orders", "customers",
        ratio("sales", "customers").alias("sales_per_customer"),
        percent("sales", total("sales")).alias("share_pct"),
    ).orderBy("customer_segment")


def product_performance(star: Star) -> DataFrame:
    return star.aggregate(["product_name"], UNITS).select(
        "product_name", "sales", "profit", "units", margin_pct())


def top_products(star: Star, measure: str = "sales", n: int = 10) -> DataFrame:
    return (product_performance(star).orderBy(F.desc(measure), "product_name").limit(n)
            .withColumn("label", F.substring("product_name", 1, 35)))


def department_performance(star: Star) -> DataFrame:
    return (star.aggregate(["department_name"], UNITS).withColumn("margin_pct", margin_pct())
            .select("department_name", "sales", "profit", "units", "margin_pct",
                    derive.above(F.col("margin_pct"), 0).alias("status"))
            .orderBy(F.desc("sales"), "department_name"))


def discount_band_profit(star: Star) -> DataFrame:
    """All bands appear, also those without a line."""
    found = star.aggregate(["discount_band"], means={"avg_profit": "order_profit_per_order"},
                           distinct=ORDERS)
    spark = found.sparkSession
    bands = spark.createDataFrame(
        list(enumerate(derive.DISCOUNT_BANDS, 1)), "band_no INT, discount_band STRING")
    return (bands.join(found, "discount_band", "left")
            .select("band_no", "discount_band", F.coalesce("orders", F.lit(0)).alias("orders"),
                    "avg_profit", derive.above(F.col("avg_profit"), 0).alias("status"))
            .orderBy("band_no"))


def country_performance(star: Star) -> DataFrame:
    return star.aggregate(["market", "order_country"], MONEY, distinct=ORDERS).select(
        "market", "order_country", "sales", "profit", "orders", margin_pct())


def top_countries(star: Star, n: int = 15) -> DataFrame:
    """Leaders by sales, set against the unweighted mean margin of all countries."""
    mean = F.avg("margin_pct").over(Window.partitionBy())
    return (country_performance(star).withColumn("mean_margin_pct", mean)
            .orderBy(F.desc("sales"), "market", "order_country").limit(n)
            .withColumn("status", derive.above(F.col("margin_pct"), F.col("mean_margin_pct"))))
