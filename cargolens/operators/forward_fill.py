"""Forward fill over a global row order, without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cargolens.session import stage


def forward_fill(df: DataFrame, columns: list[str], seq: str) -> DataFrame:
    """Replace nulls by the last earlier value in the order of the unique ``seq``.

    Only the rows with a gap take part in a join. The values they receive come from a narrow
    projection sorted by range and stored: the value is either found inside the stored partition
    or is the last one of an earlier partition, of which there is one row for each. Leading
    nulls stay. ``seq`` may be sparse.
    """
    values = [f"_v{i}" for i in range(len(columns))]
    narrow = df.select(F.col(seq).alias("_seq"), *[
        F.col(f"`{c}`").alias(v) for c, v in zip(columns, values)])
    placed = stage(narrow.repartitionByRange("_seq").sortWithinPartitions("_seq")
                   .withColumn("_part", F.spark_partition_id()), "forward-fill")

    tails = placed.groupBy("_part").agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), F.col("_seq"))).alias(v) for v in values])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(
        "_part", *[F.last(v, ignorenulls=True).over(earlier).alias(f"_carry{v}") for v in values])

    so_far = (Window.partitionBy("_part").orderBy("_seq")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    gap = " or ".join(f"{v} is null" for v in values)
    filled = (placed
              .withColumns({f"_in{v}": F.last(v, ignorenulls=True).over(so_far) for v in values})
              .where(gap)
              .join(F.broadcast(carried), "_part", "left")   # one row for each stored partition
              .select("_seq", *[F.coalesce(f"_in{v}", f"_carry{v}").alias(f"_fill{v}")
                                for v in values]))

    has_gap = F.lit(False)
    for c in columns:
        has_gap = has_gap | F.col(f"`{c}`").isNull()
    fills = {c: F.coalesce(F.col(f"`{c}`"), F.col(f"_fill{v}")) for c, v in zip(columns, values)}
    repaired = df.where(has_gap).join(filled, F.col(seq) == F.col("_seq"), "left").withColumns(
        fills).select(*[f"`{c}`" for c in df.columns])
    return df.where(~has_gap).unionByName(repaired)
