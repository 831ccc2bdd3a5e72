"""First row per key, the rule that splits a dimension off a wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def first_row_per_key(df: DataFrame, key: str, columns: list[str],
                      order: str | list[str]) -> DataFrame:
    """The row of each key that comes first in ``order``.

    ``order`` is best the name of a row number: a BIGINT that no two rows share. Then a hash
    aggregate finds the least number of each key, two longs wide, and the rows with these numbers
    are fetched by a join whose plan follows from the number of keys: few are broadcast, so the
    wide rows don't move at all. Both read ``df``: pass stored rows, or rows whose numbers don't
    change between reads.

    A list of columns is for rows without a number. It needs a rank wider than a hash aggregate can
    keep, so every task sorts its rows; columns not in ``order`` break ties, so the result doesn't
    depend on task timing.

    Either way every map task reduces its rows to one per key before the shuffle: a hot key costs
    one row per task. Nulls in ``key`` are a key.
    """
    rest = [c for c in columns if c != key]
    if isinstance(order, str):
        first = df.groupBy(key).agg(F.min(order).alias("_first")).select("_first")
        return df.join(first, F.col(order) == F.col("_first"), "left_semi").select(key, *rest)
    # The rank holds all of the row, so the least rank is the row: it isn't carried a second time.
    rank = F.struct(*order, *[c for c in rest if c not in order])
    found = df.groupBy(key).agg(F.min(rank).alias("_row"))
    return found.select(key, *[F.col("_row")[c].alias(c) for c in rest])
