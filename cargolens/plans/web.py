"""Web traffic reports over cleaned hits (see ``pipeline.clean_weblogs``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cargolens.functions import derive
from cargolens.functions.numbers import percent, zero_safe_corr
from cargolens.operators.star import Star
from cargolens.plans.sales import total


def _named(hits: DataFrame, short: str) -> str:
    """The extract calls it ``product``, the warehouse ``product_name``."""
    return short if short in hits.columns else f"{short}_name"


def web_totals(hits: DataFrame, approximate: bool = False) -> DataFrame:
    product = _named(hits, "product")
    distinct = F.approx_count_distinct(product) if approximate else F.countDistinct(product)
    return hits.agg(F.count("*").alias("hits"), distinct.alias("products"))


def _views(hits: DataFrame, column: str) -> DataFrame:
    return hits.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("views"))


def top_viewed(hits: DataFrame, what: str = "product", n: int = 10) -> DataFrame:
    column = _named(hits, what)
    return _views(hits, column).orderBy(F.desc("views"), column).limit(n)


def web_hourly(hits: DataFrame) -> DataFrame:
    return (hits.where(F.col("hour").isNotNull()).groupBy("hour")
            .agg(F.count("*").alias("hits")).orderBy("hour"))


def cart_conversion(hits: DataFrame) -> DataFrame:
    mix = (hits.where(F.col("is_add_to_cart").isNotNull())
           .groupBy("is_add_to_cart").agg(F.count("*").alias("hits")))
    return (mix.select("is_add_to_cart", derive.action_type(F.col("is_add_to_cart"))
                       .alias("action_type"), "hits",
                       percent("hits", total("hits")).alias("share_pct"))
            .orderBy("is_add_to_cart"))


def views_vs_sales(hits: DataFrame, star: Star, n: int = 50) -> DataFrame:
    """Leading products by views among those that sold. Both sides are aggregated first."""
    views = _views(hits, _named(hits, "product")).toDF("product_name", "views")
    sales = star.aggregate(["product_name"], {"sales": "sales"}).drop("lines")
    return views.join(sales, "product_name").orderBy(F.desc("views"), "product_name").limit(n)


def views_sales_corr(hits: DataFrame, star: Star, n: int = 50, digits: int = 6) -> DataFrame:
    return views_vs_sales(hits, star, n).agg(
        F.count("*").alias("products"),
        F.round(zero_safe_corr("views", "sales"), digits).alias("correlation"))
