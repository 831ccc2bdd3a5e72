"""Star schema: split, join, and aggregate-before-join."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cargolens.functions import derive
from cargolens.functions.numbers import ratio
from cargolens.operators.cleaning import present
from cargolens.operators.first_row import first_row_per_key
from cargolens.schemas import (CUSTOMER_COLUMNS, DIMENSION_KEYS, FACT_COLUMNS, ORDER_COLUMNS,
                               PRODUCT_COLUMNS, dimension_of)

TableSource = Callable[[Sequence[str]], DataFrame]


# --- split (wide cleaned lines -> star tables) --------------------------------

def fact_orders(wide: DataFrame) -> DataFrame:
    return wide.select(present(wide, FACT_COLUMNS))


Rules = Mapping[str, tuple[list[str], Callable[..., Column]]]


def _derive(df: DataFrame, rules: Rules) -> DataFrame:
    """Add each derived column whose inputs exist."""
    return df.withColumns({
        name: rule(*[F.col(c) for c in inputs]) for name, (inputs, rule) in rules.items()
        if set(inputs) <= set(df.columns)})


def dim_customer(wide: DataFrame, order: str | list[str]) -> DataFrame:
    dim = first_row_per_key(wide, "customer_id", present(wide, CUSTOMER_COLUMNS), order)
    return _derive(dim, {"customer_full_location": (
        ["customer_city", "customer_country"], derive.full_location)})


def dim_product(wide: DataFrame, order: str | list[str]) -> DataFrame:
    dim = first_row_per_key(wide, "product_card_id", present(wide, PRODUCT_COLUMNS), order)
    return _derive(dim, {"stock_status": (["product_status"], derive.stock_status),
                         "price_range": (["product_price"], derive.price_range)})


def dim_order(wide: DataFrame, order: str | list[str]) -> DataFrame:
    dim = first_row_per_key(wide, "order_id", present(wide, ORDER_COLUMNS), order)
    return _derive(dim, {"status_group": (["order_status"], derive.status_group),
                         "delivery_risk_flag": (["delivery_status"], derive.delivery_risk_flag)})


def calendar(bounds: DataFrame) -> DataFrame:
    """Date dimension from a one-row frame (first_day, last_day), both inclusive."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date"))
    d = F.col("date")
    return days.select(
        d, F.year(d).alias("year"), F.month(d).alias("month_num"),
        derive.month_name(d).alias("month_name"), derive.quarter_label(d).alias("quarter"),
        derive.day_name(d).alias("day_of_week"), F.weekofyear(d).alias("week_number"),
        derive.is_weekend(d).alias("is_weekend"), derive.year_month(d).alias("year_month"),
        derive.fiscal_quarter(d).alias("fiscal_quarter"))


def calendar_between(spark, first_day: str, last_day: str) -> DataFrame:
    return calendar(spark.range(1).select(
        F.lit(first_day).cast("date").alias("first_day"),
        F.lit(last_day).cast("date").alias("last_day")))


def whole_years(df: DataFrame, timestamp: str) -> DataFrame:
    """Calendar bounds that cover every year with a row."""
    first, last = F.min(timestamp).cast("date"), F.max(timestamp).cast("date")
    return df.agg(
        F.trunc(first, "year").alias("first_day"),
        F.date_sub(F.add_months(F.trunc(last, "year"), 12), 1).alias("last_day"))


# --- the star -----------------------------------------------------------------

def fact_expression(name: str) -> tuple[list[str], Column] | None:
    """Fact columns that are computed on request rather than stored."""
    if name == "order_date":
        return ["order_date_dateorders"], F.col("order_date_dateorders").cast("date")
    if name == "fraud_line":
        return ["is_fraud"], derive.fraud_flag(F.col("is_fraud"))
    if name == "late_line":
        return ["late_delivery_risk"], F.when(F.col("late_delivery_risk") == 1, 1).otherwise(0)
    if name == "discount_band":
        return (["order_item_discount_rate"],
                derive.discount_band(F.col("order_item_discount_rate")))
    return None


class Star:
    """A fact table and its dimensions, as sources that take the columns wanted.

    A source is a function from column names to a DataFrame, so a query only plans the
    scans and joins its own columns need: an unused left join is not removed by the
    optimizer once a SUM depends on the row count.
    """

    def __init__(self, fact: TableSource, dimensions: Mapping[str, TableSource]):
        self._fact = fact
        self._dimensions = dict(dimensions)

    @classmethod
    def of_tables(cls, fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> Star:
        def source(df: DataFrame) -> TableSource:
            return lambda columns: df.select(*columns)
        return cls(source(fact), {name: source(df) for name, df in dimensions.items()})

    def fact(self, columns: Sequence[str]) -> DataFrame:
        columns = list(dict.fromkeys(columns))
        computed = {c: e for c in columns if (e := fact_expression(c))}
        stored = [c for c in columns if c not in computed]
        needs = stored + [n for inputs, _ in computed.values() for n in inputs]
        base = self._fact(list(dict.fromkeys(needs)))
        return base.select(*stored, *[e.alias(c) for c, (_, e) in computed.items()])

    def dimension(self, name: str, columns: Sequence[str]) -> DataFrame:
        key = "date" if name == "date" else DIMENSION_KEYS[name]
        return self._dimensions[name]([key, *columns])

    def join(self, rows: DataFrame, attributes: Sequence[str]) -> DataFrame:
        """Left-join the dimensions that own ``attributes`` onto rows with their keys.

        Broadcasting is left to the planner's size check; only the calendar, bounded by
        the number of days, could be forced and does not need to be.
        """
        wanted: dict[str, list[str]] = {}
        for attribute in attributes:
            owner = dimension_of(attribute)
            if owner:
                wanted.setdefault(owner, []).append(attribute)
        for name, columns in wanted.items():
            dim = self.dimension(name, columns)
            if name == "date":
                dim = dim.withColumnRenamed("date", DIMENSION_KEYS["date"])
            rows = rows.join(dim, DIMENSION_KEYS[name], "left")
        return rows

    def lines(self, columns: Sequence[str]) -> DataFrame:
        """Line-grain star join carrying exactly ``columns``."""
        keys = [DIMENSION_KEYS[d] for c in columns if (d := dimension_of(c))]
        own = [c for c in columns if not dimension_of(c)]
        return self.join(self.fact([*own, *keys]), columns).select(*columns)

    def aggregate(self, by: Sequence[str] = (), sums: Mapping[str, str] = {},
                  means: Mapping[str, str] = {}, distinct: Mapping[str, str] = {},
                  blank_as_zero: bool = True, typed: bool = False) -> DataFrame:
        """Group the star by attributes of any table.

        ``sums`` and ``means`` map an output name to a fact column, ``distinct`` to a fact
        key to count; ``lines`` is always there. Rows with a null group key are left out.
        A sum without values is 0 for reports, NULL if ``blank_as_zero`` is off. Sums come
        as DOUBLE or BIGINT; with ``typed`` they keep the type Spark gives them, so that a
        DECIMAL can be summed further without loss.

        The fact is first reduced to one row per foreign key (and counted key), which
        needs no join, and only these rows meet the dimensions. A key that holds a third
        of the fact is one row per task before anything is shuffled for it.
        """
        values = list(dict.fromkeys([*sums.values(), *means.values()]))
        owned = [c for c in by if dimension_of(c)]
        own = [c for c in by if not dimension_of(c)]
        foreign = [DIMENSION_KEYS[dimension_of(c)] for c in owned]
        rows = self.fact([*own, *foreign, *distinct.values(), *values])

        if not owned:
            parts = {f"_s_{v}": F.col(v) for v in values}
            parts |= {f"_n_{v}": F.when(F.col(v).isNotNull(), 1) for v in means.values()}
            for c in own:
                rows = rows.where(F.col(c).isNotNull())
            counted = [c for c in dict.fromkeys(distinct.values()) if c not in own]
            rows = rows.select(*own, *counted, F.lit(1).alias("_lines"), *[e.alias(n) for n, e in parts.items()])
            unique_key = None
        else:
            level = list(dict.fromkeys([*own, *foreign, *distinct.values()]))
            rows = rows.groupBy(*level).agg(
                F.count("*").alias("_lines"),
                *[F.sum(v).alias(f"_s_{v}") for v in values],
                *[F.count(v).alias(f"_n_{v}") for v in dict.fromkeys(means.values())])
            rows = self.join(rows, owned)
            for c in by:
                rows = rows.where(F.col(c).isNotNull())
            unique_key = level[0] if len(level) == 1 else None

        def total(value: str) -> Column:
            result = F.sum(f"_s_{value}")
            if not typed:
                kind = dict(rows.dtypes)[f"_s_{value}"]
                result = result.cast("double" if kind[:3] in ("dec", "dou") else "bigint")
            return F.coalesce(result, F.lit(0)) if blank_as_zero else result

        outputs = [F.coalesce(F.sum("_lines"), F.lit(0)).cast("bigint").alias("lines")]
        outputs += [total(v).alias(name) for name, v in sums.items()]
        outputs += [ratio(F.sum(f"_s_{v}"), F.sum(f"_n_{v}")).alias(name)
                    for name, v in means.items()]
        outputs += [(F.count(k) if k == unique_key else F.countDistinct(k)).alias(name)
                    for name, k in distinct.items()]
        return rows.groupBy(*by).agg(*outputs)
