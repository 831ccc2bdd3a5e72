"""Shipping, delivery and fraud reports over a ``Star``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cargolens.functions import derive
from cargolens.functions.numbers import percent
from cargolens.operators.star import Star
from cargolens.plans.sales import ORDERS, total

LATE = {"late": "late_delivery_risk"}
DELAY = {"avg_delay": "shipping_delay_days"}
FRAUD = {"fraud_lines": "fraud_line"}


def late_overall(star: Star) -> DataFrame:
    return star.aggregate(means={**LATE, **DELAY}).select(
        (F.col("late") * 100).alias("late_rate_pct"), "avg_delay")


def shipping_mode_performance(star: Star) -> DataFrame:
    modes = star.aggregate(["shipping_mode"], means={**LATE, **DELAY}, distinct=ORDERS)
    return (modes.withColumn("late_rate_pct", F.col("late") * 100)
            .select("shipping_mode", "orders", "late_rate_pct", "avg_delay",
                    derive.risk_level(F.col("late_rate_pct"), 50, 30).alias("status"))
            .orderBy("shipping_mode"))


def delivery_status_mix(star: Star) -> DataFrame:
    mix = star.aggregate(["delivery_status"])
    return (mix.select("delivery_status", "lines",
                       percent("lines", total("lines")).alias("share_pct"))
            .orderBy(F.desc("lines"), "delivery_status"))


def region_late_rate(star: Star) -> DataFrame:
    return (star.aggregate(["order_region"], means=LATE)
            .select("order_region", (F.col("late") * 100).alias("late_rate_pct"))
            .withColumn("status", derive.risk_level(F.col("late_rate_pct"), 55, 45))
            .orderBy("late_rate_pct", "order_region"))


def fraud_summary(star: Star) -> DataFrame:
    """One row per fraud label with its lines, share of all lines and revenue."""
    labels = star.aggregate(["is_fraud"], {"revenue": "sales"})
    return (labels.select("is_fraud", "lines",
                          percent("lines", total("lines")).alias("share_pct"),
                          "revenue", derive.fraud_flag(F.col("is_fraud")).alias("is_fraud_row"))
            .orderBy(F.desc("lines"), "is_fraud"))


def fraud_by_market(star: Star) -> DataFrame:
    return (star.aggregate(["market"], FRAUD)
            .select("market", percent("fraud_lines", "lines").alias("fraud_rate_pct"))
            .withColumn("status", derive.above(F.col("fraud_rate_pct"), 10))
            .orderBy("fraud_rate_pct", "market"))


def fraud_by_mode(star: Star) -> DataFrame:
    return (star.aggregate(["shipping_mode"], FRAUD)
            .select("shipping_mode", percent("fraud_lines", "lines").alias("fraud_rate_pct"))
            .orderBy("shipping_mode"))
