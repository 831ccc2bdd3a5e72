"""Dashboard measures: name a grouping and the measures to evaluate under it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cargolens.functions.numbers import ratio
from cargolens.operators.star import Star

SUMS = {
    "total_sales": "sales", "total_revenue": "net_revenue",
    "total_profit": "order_profit_per_order", "total_quantity": "order_item_quantity",
    "late_lines": "late_line", "fraud_orders": "fraud_line",
}
DISTINCT = {"total_orders": "order_id", "customers": "customer_id"}
MEANS = {"avg_shipping_delay": "shipping_delay_days", "late_line_rate": "late_delivery_risk"}
RATIOS = {
    "avg_order_value": ("total_sales", "total_orders"),
    "profit_margin": ("total_profit", "total_sales"),
    "profit_per_customer": ("total_profit", "customers"),
    # Lines over distinct orders, as the dashboard defines it: may exceed 1.
    "late_lines_per_order": ("late_lines", "total_orders"),
    "fraud_lines_per_order": ("fraud_orders", "total_orders"),
    "fraud_line_rate": ("fraud_orders", "lines"),
}
# A measure with its own filter would have to override a grouping on the same column.
FILTERED = {"late_lines": "late_delivery_risk", "fraud_orders": "is_fraud"}
ALL_MEASURES = [
    "total_sales", "total_revenue", "total_profit", "total_orders", "total_quantity",
    "avg_order_value", "profit_margin", "profit_per_customer", "late_lines_per_order",
    "late_line_rate", "avg_shipping_delay", "fraud_orders", "fraud_lines_per_order",
    "fraud_line_rate",
]


def measures(star: Star, by: Sequence[str] = (),
             names: Sequence[str] = ALL_MEASURES) -> DataFrame:
    """One row per group with the measures in ``names``; blanks are NULL.

    Only the sums and distinct counts these measures are made of are planned.
    """
    unknown = [n for n in names if n not in {*SUMS, *DISTINCT, *MEANS, *RATIOS}]
    if unknown:
        raise ValueError(f"unknown measures: {unknown}")
    parts = {p for n in names for p in RATIOS.get(n, (n,))}
    for part in parts & FILTERED.keys():
        if FILTERED[part] in by:
            raise ValueError(f"{part} filters {FILTERED[part]}, which cannot be a group too")
    grouped = star.aggregate(
        by, {k: v for k, v in SUMS.items() if k in parts},
        {k: v for k, v in MEANS.items() if k in parts},
        {k: v for k, v in DISTINCT.items() if k in parts}, blank_as_zero=False)
    outputs = [ratio(*RATIOS[n]).alias(n) if n in RATIOS else F.col(n) for n in names]
    return grouped.select(*by, *outputs)
