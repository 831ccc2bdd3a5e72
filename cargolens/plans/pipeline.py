"""Raw extracts to star tables, as one lazy plan per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from cargolens.functions import derive
from cargolens.functions.text import standard_name, to_int, to_timestamp
from cargolens.operators import cleaning, star
from cargolens.operators.dictionary import data_dictionary
from cargolens.operators.forward_fill import forward_fill
from cargolens.schemas import (DROPPED_COLUMNS, FLOAT_COLUMNS, INFERRED_INT_COLUMNS, INT_COLUMNS,
                               RAW_DATE_COLUMNS, RAW_NUMERIC_FIELDS, WEBLOG_REQUIRED)
from cargolens.session import stage
from cargolens.sources import readers, writers


class CleaningMetrics:
    """Counts of one cleaning run, taken by the tasks that store its rows: no pass of their own."""

    def __init__(self) -> None:
        self.unique, self.filled = Observation(), Observation()

    def of_unique(self, marks: DataFrame) -> DataFrame:
        """Above the merging of equal rows, so in the tasks that write."""
        return marks.observe(self.unique, F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_before"),
                             F.count("*").alias("unique"),
                             F.coalesce(F.sum("_missing"), F.lit(0)).alias("missing_before"))

    def of_filled(self, marks: DataFrame, dates: list[str]) -> DataFrame:
        gaps = F.col("_unfilled") + missing(dates)
        return marks.observe(self.filled, F.count("*").alias("rows_after"),
                             F.coalesce(F.sum(gaps), F.lit(0)).alias("missing_after"))

    def values(self, raw: DataFrame) -> list[tuple[str, int]]:
        """After the rows have been stored: (metric, value), with the columns of the extract."""
        columns, dropped = len(raw.columns) - 1, len(cleaning.present(raw, DROPPED_COLUMNS))
        found = {**self.unique.get, **self.filled.get}
        found |= {"duplicate_rows": found["rows_before"] - found["unique"], "columns_before": columns,
                  "columns_dropped": dropped, "columns_after": columns - dropped}
        return [(m, int(found[m])) for m in METRICS]


METRICS = ["rows_before", "rows_after", "duplicate_rows", "missing_before", "missing_after",
           "columns_before", "columns_dropped", "columns_after"]


def missing(names: list[str]) -> Column:
    """Number of nulls in a row."""
    gaps = F.array(*[cleaning.quoted(c).isNull() for c in names])
    return F.size(F.array_remove(gaps, False)) if names else F.lit(0)


# Two digests, the missing cells of a row, and those that fixed values don't fill.
MARKS = ["_first", "_second", "_missing", "_unfilled"]


def mark_orders(raw: DataFrame, row_seq: str, formats: list[str]) -> DataFrame:
    """Unused columns off, timestamps read, missing cells but dates filled, with ``MARKS``. Defines row
    identity: equal rows share both digests, which are taken before anything is filled."""
    slim = cleaning.drop_columns(raw, DROPPED_COLUMNS)
    dated = cleaning.canonical_numbers(cleaning.parse_timestamps(slim, RAW_DATE_COLUMNS, formats))
    dates, cells = cleaning.present(dated, RAW_DATE_COLUMNS), [c for c in dated.columns if c != row_seq]
    first, second = cleaning.digest(dated, [row_seq])
    marked = dated.withColumns({"_first": first, "_second": second, "_missing": missing(cells)})
    return fill_orders(marked, row_seq).withColumn("_unfilled", missing([c for c in cells if c not in dates]))


def unique_rows(marked: DataFrame, row_seq: str, dates: list[str],
                metrics: CleaningMetrics | None = None) -> DataFrame:
    """Number, dates, copies and missing values of each unique row, stored. Only digests are brought
    together to find equal rows, not the rows themselves, some fifty columns."""
    # Equal rows have equal dates and gaps, so any of them will do.
    unique = marked.groupBy("_first", "_second").agg(
        F.min(row_seq).alias(row_seq), *[F.first(cleaning.quoted(c)).alias(c) for c in dates],
        F.count("*").alias("_copies"), F.first("_missing").alias("_missing"),
        F.first("_unfilled").alias("_unfilled")).drop("_first", "_second")
    return stage(metrics.of_unique(unique) if metrics else unique, "orders_unique")


def fill_orders(rows: DataFrame, row_seq: str) -> DataFrame:
    """Fixed values for missing cells; the dates follow by ``fill_dates``."""
    return cleaning.fill_missing(rows, RAW_NUMERIC_FIELDS, skip=[row_seq])


def fill_dates(unique: DataFrame, row_seq: str, dates: list[str],
               metrics: CleaningMetrics | None = None) -> DataFrame:
    """Numbers of the unique rows with their dates, gaps filled by the last one before."""
    filled = forward_fill(unique, dates, row_seq) if dates else unique
    filled = metrics.of_filled(filled, dates) if metrics else filled
    return filled.select(row_seq, *map(cleaning.quoted, dates))


def derive_orders(rows: DataFrame) -> DataFrame:
    """Derived columns, each only if its inputs exist."""
    have, c = set(rows.columns), F.col
    new = {}
    if "order_date_dateorders" in have:
        new |= derive.order_date_parts(c("order_date_dateorders"))
    if {"days_for_shipping_real", "days_for_shipment_scheduled"} <= have:
        delay = c("days_for_shipping_real") - c("days_for_shipment_scheduled")
        new |= {"shipping_delay_days": delay,
                "shipping_performance": derive.shipping_performance(delay)}
    if "order_status" in have:
        new["is_fraud"] = derive.fraud_label(c("order_status"))
    if "order_item_profit_ratio" in have:
        new |= {"profit_category": derive.profit_category(c("order_item_profit_ratio")),
                "profit_tier": derive.profit_tier(c("order_item_profit_ratio"))}
    if "order_item_discount_rate" in have:
        new["discount_tier"] = derive.discount_tier(c("order_item_discount_rate"))
    if {"sales", "order_item_discount"} <= have:
        new["net_revenue"] = c("sales") - c("order_item_discount")
    return rows.withColumns(new)


def clean_orders(raw: DataFrame, row_seq: str = "row_seq",
                 formats: list[str] = cleaning.DATE_FORMATS, money_type: str = "double",
                 metrics: CleaningMetrics | None = None) -> DataFrame:
    """Typed, complete, derived order lines.

    ``row_seq`` numbers the rows of ``raw`` (see ``with_row_seq``); it decides which date
    fills a gap and which row of a key comes first, and stays in the output. ``metrics`` gets its
    counts when the lines are stored.
    """
    # Typed and marked in the pass that stores them: reading fifty columns of text again costs as much
    # as making them. Stored, the rows have the same numbers wherever they are read.
    marked = cleaning.standardize_names(mark_orders(raw, row_seq, formats))
    rows = stage(cleaning.coerce_numbers(marked, INT_COLUMNS + INFERRED_INT_COLUMNS, FLOAT_COLUMNS, money_type),
                 "orders_typed", compression="zstd")
    number, dates = standard_name(row_seq), [standard_name(c) for c in cleaning.present(raw, RAW_DATE_COLUMNS)]
    filled = fill_dates(unique_rows(rows, number, dates, metrics), number, dates, metrics)
    names = [c for c in rows.columns if c not in MARKS]
    rows = rows.drop(*MARKS, *dates).join(filled, number).select(*names)
    return derive_orders(rows)


def clean_weblogs(raw: DataFrame, formats: list[str] = cleaning.DATE_FORMATS) -> DataFrame:
    """Deduplicated hits with their derived columns.

    Hits without product, category or date text go; an unreadable date stays, as null.
    """
    rows = cleaning.drop_incomplete(cleaning.dedupe_rows(raw), WEBLOG_REQUIRED)
    types = dict(rows.dtypes)
    date = to_timestamp(F.col("Date"), formats) if types["Date"] == "string" else F.col("Date")
    hour = to_int(F.col("Hour")) if types["Hour"] == "string" else F.coalesce("Hour", F.lit(0))
    rows = rows.withColumns({"Date": date, "Hour": hour.cast("int")})
    flag = derive.add_to_cart_flag(F.col("url"))
    rows = rows.withColumns({
        "Year": F.year("Date"), "Month_Num": F.month("Date"), "Day": F.dayofmonth("Date"),
        "is_add_to_cart": flag, "action_type": derive.action_type(flag),
        "hour_group": derive.hour_group(F.col("Hour"))})
    return rows.toDF(*["_".join(c.lower().split()) for c in rows.columns])


def build_star(clean: DataFrame, weblogs: DataFrame | None = None,
               order: str | list[str] = "row_seq", first_day: str = "2015-01-01",
               last_day: str = "2018-12-31") -> dict[str, DataFrame]:
    """Star tables of cleaned order lines; ``order``, a row number or a list of columns, ranks the
    rows of one key (see ``first_row_per_key``)."""
    tables = {
        "fact_orders": star.fact_orders(clean),
        "dim_customer": star.dim_customer(clean, order),
        "dim_product": star.dim_product(clean, order),
        "dim_order": star.dim_order(clean, order),
        "dim_date": star.calendar_between(clean.sparkSession, first_day, last_day),
    }
    if weblogs is not None:
        tables["fact_weblogs"] = weblogs
    return tables


def quality_report(raw: DataFrame, row_seq: str = "row_seq",
                   formats: list[str] = cleaning.DATE_FORMATS) -> DataFrame:
    """Metrics of one cleaning run as (metric, value): rows, columns and missing values.

    The rows themselves aren't needed twice, so only the marks of the unique ones are stored, and counted
    meanwhile; those with filled dates take one pass that keeps nothing. ``run_with_metrics`` gives the
    same of a run that publishes.
    """
    metrics, dates = CleaningMetrics(), cleaning.present(raw, RAW_DATE_COLUMNS)
    unique = unique_rows(mark_orders(raw, row_seq, formats), row_seq, dates, metrics)
    fill_dates(unique, row_seq, dates, metrics).write.format("noop").mode("overwrite").save()
    return raw.sparkSession.createDataFrame(metrics.values(raw), "metric STRING, value BIGINT")


def run_with_metrics(spark: SparkSession, orders: str, weblogs: str, dictionary: str, target: str,
                     formats: list[str] = cleaning.DATE_FORMATS, money_type: str = "double",
                     web_limit: int | None = None) -> tuple[dict[str, str], dict[str, int]]:
    """Raw CSV files to published star tables; returns the path of each table and the metrics of
    the cleaning.

    The cleaned lines are stored, so that the tables split off them do not each repeat the
    cleaning, and counted while they are. ``web_limit`` cuts the web log to its leading rows by
    time. The dictionary is optional.
    """
    described = readers.read_dictionary(spark, dictionary)
    raw = readers.with_row_seq(readers.read_orders(spark, orders))
    metrics = CleaningMetrics()
    clean = stage(clean_orders(raw, formats=formats, money_type=money_type, metrics=metrics), "orders_clean")
    hits = clean_weblogs(readers.read_weblogs(spark, weblogs), formats)
    if web_limit is not None:
        hits = writers.first_rows(hits, ["date", "product", "ip", "url"], web_limit)
    tables = build_star(clean, hits)
    if described is not None:
        tables["data_dictionary"] = data_dictionary(described)
    return writers.publish_star(tables, target), dict(metrics.values(raw))


def run(spark: SparkSession, orders: str, weblogs: str, dictionary: str, target: str,
        formats: list[str] = cleaning.DATE_FORMATS, money_type: str = "double",
        web_limit: int | None = None) -> dict[str, str]:
    """``run_with_metrics`` for those who only want the tables."""
    return run_with_metrics(spark, orders, weblogs, dictionary, target, formats, money_type, web_limit)[0]
