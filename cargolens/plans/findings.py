"""Key findings: ten (finding, value) rows from two passes over the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cargolens.functions.numbers import percent
from cargolens.operators.star import Star

# The findings as (label, grouping attribute, measure, sign of "best").
LEADERS = [
    ("Top Market by Sales", "market", "sales", 1),
    ("Top Department by Profit", "department_name", "profit", 1),
    ("Top Product by Sales", "product_name", "sales", 1),
    ("Highest Order Segment", "customer_segment", "orders", 1),
    ("Highest Late Delivery Region", "order_region", "late_rate", 1),
    ("Best Shipping Mode (On-time)", "shipping_mode", "late_rate", -1),
    ("Worst Shipping Mode (Late)", "shipping_mode", "late_rate", 1),
]
TOTALS = ["Overall Profit Margin", "Overall Late Delivery Rate", "Total Records Analyzed"]


def _grouped(rows: DataFrame, attributes: list[str], sums: list[Column],
             total: bool) -> DataFrame:
    """Aggregate once per attribute (and once overall) in a single pass."""
    sets = [[a] for a in attributes] + ([[]] if total else [])
    grouped = rows.groupingSets(sets, *attributes).agg(
        *sums, *[F.grouping(a).alias(f"_g_{a}") for a in attributes])
    which = F.coalesce(*[F.when(F.col(f"_g_{a}") == 0, a) for a in attributes])
    value = F.coalesce(*[F.when(F.col(f"_g_{a}") == 0, F.col(a)) for a in attributes])
    every = grouped.withColumns({"attribute": which, "key": value})
    return every.where("attribute is null or key is not null").drop(
        *attributes, *[f"_g_{a}" for a in attributes])


def key_findings(star: Star) -> DataFrame:
    """The winner of each grouping; ties go to the first key in sort order."""
    by_order = ["market", "customer_segment", "order_region", "shipping_mode"]
    lines = star.fact(["order_id", "customer_id", "sales", "order_profit_per_order",
                       "late_delivery_risk"])
    # One row per order and customer before the dimensions are joined.
    orders = lines.groupBy("order_id", "customer_id").agg(
        F.count("*").alias("lines"), F.sum("sales").alias("sales"),
        F.sum("order_profit_per_order").alias("profit"),
        F.sum("late_delivery_risk").alias("late"), F.count("late_delivery_risk").alias("late_n"))
    # Plain sums shrink to a few rows per task before the shuffle; a distinct count among them
    # would send every order once per grouping. Only one contest counts orders.
    counts = (star.join(orders.select("order_id", "customer_id"), ["customer_segment"])
              .where("customer_segment is not null").groupBy(F.col("customer_segment").alias("key"))
              .agg(F.countDistinct("order_id").alias("orders"))
              .withColumn("attribute", F.lit("customer_segment")))
    orders = _grouped(star.join(orders, by_order), by_order, [
        F.sum("lines").alias("lines"), F.sum("sales").cast("double").alias("sales"),
        F.sum("profit").cast("double").alias("profit"), F.sum("late").alias("late"),
        F.sum("late_n").alias("late_n")], True).join(counts, ["attribute", "key"], "left")
    by_product = ["department_name", "product_name"]
    products = star.fact(["product_card_id", "sales", "order_profit_per_order"]).groupBy(
        "product_card_id").agg(F.sum("sales").alias("sales"),
                               F.sum("order_profit_per_order").alias("profit"))
    products = _grouped(star.join(products, by_product), by_product, [
        F.sum("sales").cast("double").alias("sales"),
        F.sum("profit").cast("double").alias("profit")], False)
    groups = orders.unionByName(products, allowMissingColumns=True).withColumn(
        "late_rate", F.try_divide("late", "late_n"))

    contests = F.array(*[
        F.when(F.col("attribute") == attribute,
               F.struct(F.lit(i).alias("finding_no"), F.lit(label).alias("finding"),
                        (F.col(measure).cast("double") * sign).alias("score")))
        for i, (label, attribute, measure, sign) in enumerate(LEADERS, 1)])
    winners = (groups.where("attribute is not null")
               .select("key", F.explode(F.array_compact(contests)).alias("c"))
               .groupBy("c.finding_no", "c.finding")
               .agg(F.min_by("key", F.struct(-F.col("c.score"), "key")).alias("value"))
               .withColumn("value", F.when(F.col("finding") == "Top Product by Sales",
                                           F.substring("value", 1, 50)).otherwise(F.col("value"))))

    def pct(c: Column) -> Column:
        return F.concat(F.round(c, 1).cast("string"), F.lit("%"))

    first = len(LEADERS) + 1
    texts = [pct(percent("profit", "sales")), pct(F.col("late_rate") * 100),
             F.format_number("lines", 0)]
    totals = groups.where("attribute is null").select(F.explode(F.array(*[
        F.struct(F.lit(first + i).alias("finding_no"), F.lit(label).alias("finding"),
                 text.alias("value")) for i, (label, text) in enumerate(zip(TOTALS, texts))]))
        .alias("t")).select("t.*")
    return winners.unionByName(totals).orderBy("finding_no")
