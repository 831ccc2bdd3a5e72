"""Calendar filters that reach the fact's partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cargolens.sources.writers import PARTITIONS


def on_days(fact: DataFrame, days: DataFrame, date: str = "order_date_dateorders") -> DataFrame:
    """Rows of the partitioned order fact on the ``days`` of the calendar, chosen by any of its
    attributes: ``on_days(fact, calendar.where("fiscal_quarter = 'FY2017-Q2'"))``.

    The fact is stored by year and month, the filter is on something else. The months of the chosen
    days, a few rows that no fact can make more, are sent to every task; Spark turns them into a
    filter on partitions while the query runs, so files of other months aren't opened. The days
    themselves are then matched row by row. Rows without a date match none.
    """
    year, month = PARTITIONS["fact_orders"]
    months = days.select(F.col("year").alias(year), F.col("month_num").alias(month)).distinct()
    dates = F.broadcast(days.select(F.col("date").alias("_day")))
    return (fact.join(F.broadcast(months), [year, month], "left_semi")
            .join(dates, F.col(date).cast("date") == F.col("_day"), "left_semi"))
