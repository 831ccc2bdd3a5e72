"""Gapless row numbers without a window over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cargolens.session import stage

PARTITION_SHIFT = 33  # monotonically_increasing_id keeps the partition above these bits


def number_rows(df: DataFrame, order: list[str], name: str, by: list[str] | None = None,
                descending: bool = False) -> DataFrame:
    """Add ``name``: numbers from 0 in the order of ``order``, anew for each value of ``by``.

    The rows are sorted across the cluster by range and stored with their place. Each stored
    partition is then counted (one row for each partition and group it holds), the counts before
    it give its first number. No task sees more than its range, however large a group is. Rows
    equal in all of ``order`` are numbered in any order, but the same one on every read. The
    input is evaluated twice, for the range borders and for the sort: pass stored rows.
    Nulls in ``by`` are a group; nulls in ``order`` come first, or last if descending.
    """
    by = by or []
    way = F.desc if descending else F.asc
    keys = [F.asc(c) for c in by] + [way(c) for c in order]
    place, part = f"__{name}_place", f"__{name}_part"
    placed = stage(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .withColumn(place, F.monotonically_increasing_id()), name)
    placed = placed.withColumn(part, F.shiftright(place, PARTITION_SHIFT))
    counts = placed.groupBy(part, *by).agg(F.count("*").alias("n"), F.min(place).alias("first"))
    before = F.sum("n").over(Window.partitionBy(*by).orderBy(part)
                             .rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(
        F.col(part).alias("__part"), *[F.col(c).alias(f"__by_{c}") for c in by],
        (F.coalesce(before, F.lit(0)) - F.col("first")).alias("__shift"))
    match = F.col(part) == F.col("__part")
    for c in by:
        match &= F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    if not by:
        starts = F.broadcast(starts)  # one row for each stored partition
    return (placed.join(starts, match)
            .select(*df.columns, (F.col(place) + F.col("__shift")).alias(name)))
