"""Time intelligence on the calendar: last year, growth, to-date and rolling sums.

The fact is reduced once to one row per day (and group), which is stored; spine, totals and
windows are derived from it, so every measure scans the fact once. Everything after that is
bounded by the calendar: days between the first and last order times groups. Every measure
covers every period of that calendar; a period, or a window, without orders is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cargolens.functions.numbers import ratio
from cargolens.operators.star import Star
from cargolens.session import stage

MEASURES = {"sales": "sales", "profit": "order_profit_per_order"}
GRAINS = {"day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH", "quarter": "INTERVAL 3 MONTH",
          "year": "INTERVAL 1 YEAR"}


def daily(star: Star, by: Sequence[str] = ()) -> DataFrame:
    """Sales and profit per order day, days without orders absent; stored."""
    return stage(star.aggregate([*by, "order_date"], MEASURES, typed=True)
                 .select(*by, F.col("order_date").alias("day"), *MEASURES), "daily")


def _start(grain: str, day: Column) -> Column:
    return day if grain == "day" else F.trunc(day, grain)


def on_calendar(days: DataFrame, by: Sequence[str] = (), grain: str = "day") -> DataFrame:
    """Totals of every period (named as ``grain``) from the first to the last order day, for every
    group; periods without orders are NULL. ``days`` is read several times: pass stored rows."""
    bounds = days.agg(F.struct(_start(grain, F.min("day")).alias("lo"),
                               _start(grain, F.max("day")).alias("hi")).alias("b"))
    if by:
        groups = days.select(*by).distinct().withColumn("b", bounds.scalar())
    else:
        groups = bounds
    spine = groups.where("b.lo is not null").select(
        *by, F.explode(F.sequence("b.lo", "b.hi", F.expr(GRAINS[grain]))).alias(grain))
    totals = days.groupBy(*by, _start(grain, F.col("day")).alias(grain)).agg(
        *[F.sum(m).alias(m) for m in MEASURES])
    return spine.join(totals, [*by, grain], "left")


def to_date(star: Star, period: str, by: Sequence[str] = (), measure: str = "sales") -> DataFrame:
    """Running total since the start of the ``month``, ``quarter`` or ``year`` of each day."""
    starts = Window.partitionBy(*by, F.trunc("day", period)).orderBy("day").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    name = {"month": "mtd", "quarter": "qtd", "year": "ytd"}[period]
    return on_calendar(daily(star, by), by).select(
        *by, "day", F.col(measure).cast("double"),
        F.sum(measure).over(starts).cast("double").alias(f"{name}_{measure}"))


def _with_last_year(star: Star, by: Sequence[str], grain: str) -> DataFrame:
    """The shift goes back from the later period, so February 29 reads February 28."""
    now = on_calendar(daily(star, by), by, grain)
    before = now.select(*by, F.col(grain).alias("_then"),
                        *[F.col(m).alias(f"ly_{m}") for m in MEASURES])
    return now.withColumn("_then", F.add_months(grain, -12)).join(before, [*by, "_then"], "left")


def last_year(star: Star, by: Sequence[str] = (), grain: str = "day",
              measure: str = "sales") -> DataFrame:
    """A measure of each period beside that of the same period a year before."""
    return _with_last_year(star, by, grain).select(
        *by, grain, *[F.col(c).cast("double") for c in (measure, f"ly_{measure}")])


def growth(star: Star, by: Sequence[str] = (), grain: str = "month") -> DataFrame:
    """Totals of each period, of the same one a year before, and relative growth. NULL where there
    is no year before; a period without orders is a decline by all."""
    both = _with_last_year(star, by, grain)

    def change(m: str) -> Column:
        return ratio(F.coalesce(m, F.lit(0)) - F.col(f"ly_{m}"), f"ly_{m}")

    return both.select(
        *by, grain, *[F.col(c).cast("double") for c in ("sales", "profit", "ly_sales", "ly_profit")],
        *[change(m).alias(f"yoy_{m}_growth") for m in MEASURES])


def rolling_days(star: Star, by: Sequence[str] = (), months: int = 3,
                 measure: str = "sales") -> DataFrame:
    """Total of the days in (day - months, day] for every calendar day.

    The running total of the day less that of the day before the window: a window over the
    calendar and an equi join. Totals are decimal, so that the difference is exact.
    """
    upto = Window.partitionBy(*by).orderBy("day").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    days = on_calendar(daily(star, by), by)
    running = days.select(
        *by, "day", F.sum(F.coalesce(F.col(measure).cast("decimal(28,6)"), F.lit(0))).over(upto)
        .alias("total"), F.count(measure).over(upto).alias("n"))
    before = running.select(*by, F.col("day").alias("_from"), F.col("total").alias("_total"),
                            F.col("n").alias("_n"))
    both = running.withColumn("_from", F.add_months("day", -months)).join(before, [*by, "_from"], "left")
    total = F.col("total") - F.coalesce("_total", F.lit(0))
    return both.select(*by, "day", F.when(F.col("n") > F.coalesce("_n", F.lit(0)), total)
                       .cast("double").alias(f"rolling_{measure}"))


def rolling_months(star: Star, by: Sequence[str] = (), months: int = 3,
                   measure: str = "sales") -> DataFrame:
    """Total of each month and the ones before it, ``months`` in all."""
    window = Window.partitionBy(*by).orderBy("month").rowsBetween(1 - months, Window.currentRow)
    return on_calendar(daily(star, by), by, "month").select(
        *by, "month", F.col(measure).cast("double"),
        F.sum(measure).over(window).cast("double").alias(f"rolling_{measure}"))
