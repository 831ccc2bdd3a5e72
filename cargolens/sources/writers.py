"""Sinks: partitioned star tables, the warehouse refresh, row-count checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from cargolens.functions.numbers import nan_to_null
from cargolens.operators.row_numbers import number_rows
from cargolens.session import stage

PARTITIONS = {"fact_orders": ["order_year", "order_month"]}


def nulls_for_nan(df: DataFrame) -> DataFrame:
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: nan_to_null(c) for c in floats}) if floats else df


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                dealt: bool = False) -> None:
    """Overwrite one Parquet table.

    For a partitioned table the REBALANCE hint brings the rows of one partition
    value together, so tasks do not each write a small file per value, and splits
    an oversized value over several tasks. ``dealt`` says that the rows have been through it.
    """
    writer = df
    if partition_by and not dealt:
        writer = df.hint("rebalance", *partition_by)
    writer = writer.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


EXTRACT_ROWS = 1_000_000  # of one compressed file, which one task reads


def write_extract(df: DataFrame, path: str, **options: str) -> None:
    """An extract as CSV files with headers, compressed; readers tell from the files' names. Text of
    numbers shrinks to a tenth. No file holds more rows than a task may well read."""
    (df.write.options(header=True, compression="gzip", maxRecordsPerFile=EXTRACT_ROWS, **options)
     .csv(path))


def publish_star(tables: dict[str, DataFrame], base: str, dealt: Sequence[str] = ()) -> dict[str, str]:
    """Write every table that has columns; one action per table. ``dealt`` names those whose rows
    have been brought together by partition."""
    paths = {}
    for name, df in tables.items():
        if not df.columns:
            continue
        paths[name] = f"{base.rstrip('/')}/{name}"
        keys = [c for c in PARTITIONS.get(name, []) if c in df.columns]
        write_table(nulls_for_nan(df), paths[name], keys, name in dealt)
    return paths


def first_rows(df: DataFrame, order: list[str], limit_rows: int) -> DataFrame:
    """Leading rows by an explicit order: the truncated sink, off by default.

    The rows are stored and numbered by range, so no task sees more than its share of them,
    whatever the limit, the table's size or the type of the order. Nulls sort first; rows equal
    in all of ``order`` are cut at any of them.
    """
    numbered = number_rows(stage(df, "first-rows"), order, "__number")
    return numbered.where(F.col("__number") < limit_rows).drop("__number")


# Facts hold the foreign keys: they are emptied before the dimensions and loaded after them.
LOAD_ORDER = ["Dim_Date", "Dim_Customer", "Dim_Product", "Dim_Order", "Fact_Orders", "Fact_WebLogs"]


def _to_database(df: DataFrame, name: str, jdbc: dict[str, str], mode: str = "overwrite") -> None:
    (df.write.format("jdbc").options(**{"batchsize": "10000", "truncate": "true", **jdbc})
     .option("dbtable", name).mode(mode).save())


def publish_warehouse(tables: dict[str, DataFrame], base: str | None = None,
                      database: str | None = None, jdbc: dict[str, str] | None = None) -> None:
    """Full refresh of the warehouse tables, dimensions before facts.

    Goes to Parquet folders under ``base``, to catalog tables of ``database``, or,
    given ``jdbc`` options with at least ``url``, to a database. Columns are matched
    by name. The database path has not been run against one.
    """
    if jdbc:
        for name in [t for t in reversed(LOAD_ORDER) if t in tables]:
            _to_database(tables[name].limit(0), name, jdbc)
    for name in [t for t in LOAD_ORDER if t in tables]:
        df = nulls_for_nan(tables[name])
        if jdbc:
            _to_database(df, name, jdbc, "append")
        elif database:
            df.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")
        else:
            write_table(df, f"{base.rstrip('/')}/{name}")


def read_warehouse(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{base.rstrip('/')}/{name}") for name in LOAD_ORDER}


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row (table_name, row_count) per table."""
    counts = [df.agg(F.count("*").alias("row_count"))
              .select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
