"""Recency, frequency, monetary: base values, quartile scores, segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cargolens.functions import derive
from cargolens.operators.quantiles import exact_quantiles
from cargolens.operators.star import Star
from cargolens.session import stage

DAY = 86_400
QUARTILES = [0.0, 0.25, 0.5, 0.75, 1.0]


def _seconds(c: Column) -> Column:
    return F.unix_timestamp(c.cast("timestamp"))


def _typed_base(star: Star) -> DataFrame:
    """Stored once: the snapshot, the quartiles and the scores all read it."""
    lines = star.fact(["customer_id", "order_id", "order_date_dateorders", "sales"])
    per_customer = stage(lines.where("customer_id is not null").groupBy("customer_id").agg(
        F.max("order_date_dateorders").alias("last_order"),
        F.countDistinct("order_id").alias("frequency"),
        F.sum("sales").alias("monetary")), "rfm")
    snapshot = per_customer.agg(F.max(_seconds(F.col("last_order")))).scalar()
    return per_customer.select(
        "customer_id",
        F.floor((snapshot - _seconds(F.col("last_order"))) / DAY).alias("recency"),
        "frequency", "monetary")


def rfm_base(star: Star) -> DataFrame:
    """One row per customer; recency counts whole elapsed days before the last order of all."""
    return _typed_base(star).withColumn("monetary", F.col("monetary").cast("double"))


def quartile_bin(value: Column, edges: list[float]) -> Column:
    """1-based right-closed bin between the distinct edges, the lowest value included."""
    return F.lit(1) + sum(((value > e).cast("int") for e in edges[1:-1]), F.lit(0))


def _typed_scores(star: Star) -> DataFrame:
    base = _typed_base(star)
    quantiles = exact_quantiles(base, ["recency", "frequency", "monetary"], QUARTILES)
    edges = {c: list(dict.fromkeys(q or [])) for c, q in quantiles.items()}
    bins = max(len(edges["recency"]) - 1, 1)
    scored = base.withColumns({
        "r": bins + 1 - quartile_bin(F.col("recency"), edges["recency"]),
        "f": quartile_bin(F.col("frequency"), edges["frequency"]),
        "m": quartile_bin(F.col("monetary").cast("double"), edges["monetary"])})
    scored = scored.withColumn("rfm_score", F.col("r") + F.col("f") + F.col("m"))
    return scored.withColumn("segment", derive.rfm_segment(F.col("rfm_score")))


def rfm_scores(star: Star) -> DataFrame:
    """Quartile scores. Equal edges merge, so a column may have fewer than four bins; a low
    recency earns the highest label."""
    return _typed_scores(star).withColumn("monetary", F.col("monetary").cast("double"))


def rfm_segments(star: Star) -> DataFrame:
    return (_typed_scores(star).groupBy("segment")
            .agg(F.count("*").alias("customers"),
                 F.sum("monetary").cast("double").alias("revenue"))
            .orderBy(F.desc("customers"), "segment"))
