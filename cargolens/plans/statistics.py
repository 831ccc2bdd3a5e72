"""Distribution reports over the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cargolens.operators import distribution
from cargolens.operators.star import Star

CORRELATED = ["sales", "order_profit_per_order", "order_item_quantity",
              "order_item_discount_rate", "late_delivery_risk", "shipping_delay_days"]
HISTOGRAM_BINS = {"sales": 50, "order_profit_per_order": 50, "shipping_delay_days": 30}


def correlation_matrix(star: Star, columns: list[str] = CORRELATED) -> DataFrame:
    return distribution.correlation_matrix(star.fact(columns), columns)


def histogram(star: Star, column: str, bins: int | None = None) -> DataFrame:
    bins = bins or HISTOGRAM_BINS[column]
    return distribution.histogram(star.fact([column]), column, bins).orderBy("bin")


def describe_fact(star: Star, columns: list[str]) -> DataFrame:
    return distribution.describe(star.fact(columns))
