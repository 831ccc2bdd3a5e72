"""Measures of any span of days from one stored frame a day, distinct counts included.

``daily_summary`` reduces the fact once: sums per day and group, and a bitmap of the orders and of
the customers of that day. A span, a year or the whole time is then an addition of sums and an OR of
bitmaps; the fact isn't read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cargolens.functions.numbers import ratio
from cargolens.operators.bitmaps import bitmaps, counted, dense_ids
from cargolens.operators.star import Star
from cargolens.schemas import DIMENSION_KEYS, dimension_of
from cargolens.session import stage

SUMS = {"total_sales": "sales", "total_profit": "order_profit_per_order"}
COUNTED = {"orders": "order_id", "customers": "customer_id"}


@dataclass(frozen=True)
class Summary:
    """``sums``: (by, day, measures); ``bits``: (by, day, what, piece, bits)."""

    by: tuple[str, ...]
    sums: DataFrame
    bits: DataFrame


def daily_summary(star: Star, by: Sequence[str] = ()) -> Summary:
    """One stored frame of sums and one of bitmaps, per day and group. Rows without a day or with a
    null group are left out, as in ``Star.aggregate``."""
    by, keys = list(by), list(COUNTED.values())
    sums = star.aggregate([*by, "order_date"], SUMS, typed=True)
    sums = stage(sums.withColumnRenamed("order_date", "day").drop("lines"), "daily-sums")

    # Reduced before the dimensions are joined, as the sums are.
    owned = [c for c in by if dimension_of(c)]
    own = [c for c in by if not dimension_of(c)]
    level = [*own, *[DIMENSION_KEYS[dimension_of(c)] for c in owned], *keys, "order_date"]
    pairs = star.join(star.fact(list(dict.fromkeys(level))).distinct(), owned)
    pairs = pairs.na.drop(subset=[*by, "order_date"]).select(
        *by, *[c for c in keys if c not in by], "order_date")
    pairs = stage(pairs.distinct(), "daily-keys")
    parts = []
    for what, key in COUNTED.items():
        numbered = pairs.join(dense_ids(pairs, key, "order_date"), key)
        days = bitmaps(numbered.withColumnRenamed("order_date", "day"), [*by, "day"])
        parts.append(days.withColumn("what", F.lit(what)))
    bits = parts[0].unionByName(parts[1])
    return Summary(tuple(by), sums, stage(bits, "daily-bitmaps"))


def over_days(summary: Summary, by: Sequence[str] | None = None, first: str | None = None,
              last: str | None = None, grain: str | None = None) -> DataFrame:
    """Sums, orders, customers and the ratios of them, for the days from ``first`` to ``last``.

    ``by`` keeps some of the summary's groups; ``grain`` (year, quarter, month) splits the span into
    periods, named ``period``. A group without a day in the span has no row.
    """
    by = list(summary.by if by is None else by)
    groups = [*by, *(["period"] if grain else [])]

    def cut(df: DataFrame) -> DataFrame:
        if first:
            df = df.where(F.col("day") >= F.lit(first).cast("date"))
        if last:
            df = df.where(F.col("day") <= F.lit(last).cast("date"))
        return df.withColumn("period", F.trunc("day", grain)) if grain else df

    sums = cut(summary.sums).groupBy(*groups).agg(*[F.sum(m).alias(m) for m in SUMS])
    counts = counted(cut(summary.bits), [*groups, "what"])
    # A row for each group and measure: no Expand and no second reading for the second count.
    wide = counts.groupBy(*groups).agg(*[F.coalesce(F.max(F.when(F.col("what") == w, F.col("n"))), F.lit(0))
                                         .alias(w) for w in COUNTED])
    if groups:
        rows = sums.join(wide, groups)
    else:
        both = wide.select(F.struct(*COUNTED)).scalar()
        rows = sums.withColumn("_both", both).select("*", "_both.*")
    return rows.select(*groups, *[F.col(m).cast("double").alias(m) for m in SUMS], *COUNTED,
                       ratio("total_sales", "orders").alias("avg_order_value"),
                       ratio("total_profit", "customers").alias("profit_per_customer"))
