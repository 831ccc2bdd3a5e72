"""Scans: raw CSV extracts and the stored star tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cargolens.schemas import NA_TOKENS, RAW_WEBLOG_FIELDS


def text_schema(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


def missing_as_null(df: DataFrame, tokens: list[str] = NA_TOKENS) -> DataFrame:
    return df.select([F.when(~F.col(f"`{c}`").isin(tokens), F.col(f"`{c}`")).alias(c)
                      for c in df.columns])


def read_text_csv(spark: SparkSession, path: str, encoding: str, multi_line: bool = False,
                  corrupt: str | None = None) -> DataFrame:
    """CSV by its header, every column as text.

    Lines are split across tasks; ``multi_line`` lets quoted fields hold line breaks, at the price
    of one task for each file. ``corrupt`` names a column that gets the text of rows whose fields
    don't match the header, NULL for sound ones.
    """
    def reader():
        return (spark.read.option("header", True).option("encoding", encoding)
                .option("quote", '"').option("escape", '"').option("multiLine", multi_line))

    fields = reader().csv(path).columns
    schema = text_schema([*fields, *([corrupt] if corrupt else [])])
    options = {"columnNameOfCorruptRecord": corrupt} if corrupt else {"enforceSchema": False}
    return missing_as_null(reader().schema(schema).options(**options).csv(path))


def read_orders(spark: SparkSession, path: str, multi_line: bool = False,
                corrupt: str | None = None) -> DataFrame:
    """Raw orders; latin-1 decodes any byte. A missing file is an error, columns are as found."""
    return read_text_csv(spark, path, "ISO-8859-1", multi_line, corrupt)


def _if_there(read, otherwise):
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return otherwise()


def read_weblogs(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Raw web log. The source is optional: no file gives an empty table."""
    return _if_there(lambda: read_text_csv(spark, path, "UTF-8", multi_line),
                     lambda: spark.createDataFrame([], text_schema(RAW_WEBLOG_FIELDS)))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame | None:
    """Field descriptions; the two columns are named by position. None without a file."""
    return _if_there(lambda: (spark.read.schema("Field STRING, Description STRING")
                              .option("header", True).option("encoding", "UTF-8")
                              .option("quote", '"').option("escape", '"').csv(path)), lambda: None)


def read_star(spark: SparkSession, base: str, tables: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{base.rstrip('/')}/{name}") for name in tables}


def with_row_seq(df: DataFrame, order: list[str] | None = None,
                 name: str = "row_seq") -> DataFrame:
    """Number rows in scan order, or in the order of ``order`` columns.

    The sort is range-partitioned on all ordering columns and the ids grow with the
    partition index, so no task sees more than its own range. Ids are increasing but
    not dense. Stage the result before reading it in more than one branch.
    """
    if order:
        df = df.orderBy(*order)
    return df.withColumn(name, F.monotonically_increasing_id())
