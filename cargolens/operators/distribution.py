"""Histograms, correlation matrix and column profile."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from cargolens.functions.numbers import zero_safe_corr
from cargolens.operators.quantiles import (as_double, exact_quantiles, spread_columns,
                                           unpivot)
from cargolens.session import stage


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram: (bin, bin_lo, bin_hi, n), empty bins included.

    Bins are left-closed, the last one closed; a value that the division puts next to
    its bin is moved by comparing it with the bin's own edges. A constant column is
    widened by 0.5 to either side. NaN is missing.
    """
    values = df.select(as_double(column).alias("v")).where(F.col("v").isNotNull())
    lo, hi = F.min("v"), F.max("v")
    pad = F.when(lo == hi, 0.5).otherwise(0.0)
    bounds = values.agg(F.struct((lo - pad).alias("lo"), (hi + pad).alias("hi")).alias("b"))

    low, high = F.col("b.lo"), F.col("b.hi")
    step = (high - low) / bins

    def edge(i: Column) -> Column:
        return F.when(i == bins, high).otherwise(low + i * step)

    v = F.col("v")
    i = F.col("i")
    placed = (values.withColumn("b", bounds.scalar())
              .withColumn("i", F.least(F.floor((v - low) / (high - low) * bins),
                                       F.lit(bins - 1)))
              .withColumn("i", F.when(v < edge(i), i - 1)
                          .when((v >= edge(i + 1)) & (i < bins - 1), i + 1).otherwise(i)))
    counts = placed.groupBy("i").agg(F.count("*").alias("n"))
    spine = bounds.where("b.lo is not null").select(
        "b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint")))
        .alias("i"))
    return spine.join(counts, "i", "left").select(
        (i + 1).cast("int").alias("bin"), edge(i).alias("bin_lo"), edge(i + 1).alias("bin_hi"),
        F.coalesce("n", F.lit(0)).alias("n"))


def correlation_matrix(df: DataFrame, columns: list[str], digits: int = 3) -> DataFrame:
    """Lower triangle in long form (col_a, col_b, r); nulls are left out per pair.

    Each row is spread to its pairs and reduced again inside the same stage: one pass,
    a handful of moments per pair, and a shuffle of one row per pair and task. A single
    aggregate with the moments of all pairs would be too wide to compile.
    """
    pairs = list(combinations(columns, 2))
    values = df.select(*[as_double(c).alias(c) for c in columns])
    spread = values.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(a).alias("x"), F.col(b).alias("y"))
        for i, (a, b) in enumerate(pairs)])).alias("t")).select("t.*")
    moments = spread.groupBy("i").agg(zero_safe_corr("x", "y").alias("r"))
    names = F.array(*[F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"))
                      for a, b in pairs])
    return moments.select(names[F.col("i")].alias("pair"), F.round("r", digits).alias("r")).select(
        "pair.*", "r")


QUARTILES = [0.25, 0.5, 0.75]
ROW_GROUP = 4 << 20     # every row is spread to its cells in each pass


def _numbers(df: DataFrame, times: list[str], numbers: list[str]) -> DataFrame:
    """Profile rows of the stored number columns, ``times`` first."""
    measured = times + numbers
    # Unpivoted, so that the aggregate stays small enough to compile; a row per column is
    # all that leaves a task.
    rows = unpivot(df, measured).groupBy("i").agg(
        F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), *spread_columns()).collect()
    stats = {measured[r["i"]]: r for r in rows}
    quartiles = exact_quantiles(df, measured, QUARTILES, stats)
    profile = [(c, r["n"], r["mean"], None if c in times else r["std"], r["lo"], *quartiles[c], r["hi"])
               for c, r in stats.items()]
    return df.sparkSession.createDataFrame(
        profile, "column_name STRING, count BIGINT, mean DOUBLE, std DOUBLE, min DOUBLE, p25 DOUBLE, "
                 "p50 DOUBLE, p75 DOUBLE, max DOUBLE")


def _texts(df: DataFrame, text: list[str]) -> DataFrame:
    # Value counts first: a value that fills a column is one row per task, not a hot group.
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"))
                      for c in text]).cast("array<struct<column_name:string,value:string>>")
    counts = (df.select(F.explode(cells).alias("t")).select("t.*")
              .groupBy("column_name", "value").agg(F.count("*").alias("n")))
    known = F.col("value").isNotNull()
    return counts.groupBy("column_name").agg(
        F.sum(F.when(known, F.col("n")).otherwise(0)).alias("count"),
        F.count("value").alias("unique"),
        F.min_by("value", F.when(known, F.struct(-F.col("n"), "value"))).alias("top"),
        F.max(F.when(known, F.col("n"))).alias("freq"))


def describe(df: DataFrame) -> DataFrame:
    """Profile of every column with a row, one row each.

    Text columns get unique, top and freq (ties: the lowest value); numbers get mean,
    std, min, quartiles and max; timestamps get the same without std, as seconds since
    1970-01-01. Quartiles are exact, NaN is missing, and a number column without values has no
    row. The columns are stored once and read from there; a handful of numbers for each column
    comes to the driver.
    """
    types = dict(df.dtypes)
    text = [c for c in df.columns if types[c] == "string"]
    times = [c for c in df.columns if types[c] in ("timestamp", "timestamp_ntz", "date")]
    numbers = [c for c in df.columns if c not in text and c not in times]
    stored = stage(df.select(
        *text, *[F.unix_timestamp(F.col(c).cast("timestamp")).alias(c) for c in times],
        *[as_double(c).alias(c) for c in numbers]), "profile", ROW_GROUP)
    order = ["column_name", "count", "unique", "top", "freq",
             "mean", "std", "min", "p25", "p50", "p75", "max"]
    return _texts(stored, text).unionByName(
        _numbers(stored, times, numbers), allowMissingColumns=True).select(*order)
