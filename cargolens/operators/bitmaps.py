"""Exact distinct counts that add up: bitmaps over dense ids.

A distinct count of a month isn't the sum of its days' counts, and two distinct counts in one
aggregate double its rows. Here the keys get numbers from 0, and each group keeps a bitmap of the
numbers it holds, cut into pieces of 32,768 bits. Bitmaps of days merge to those of any span by OR, and
the count of their bits is the exact distinct count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cargolens.operators.row_numbers import number_rows
from cargolens.session import stage


def dense_ids(rows: DataFrame, key: str, near: str | None = None) -> DataFrame:
    """(key, id): the distinct values of ``key``, numbered from 0 without gaps; nulls have none.

    Keys are numbered in the order of the least ``near`` (a day, say) they occur with: keys of one
    day then share pieces, and a day's bitmaps are few. ``rows`` may be any size; the numbers are
    given by range, see ``number_rows``.
    """
    first = [F.min(near).alias("near")] if near else []
    known = rows.where(F.col(key).isNotNull()).groupBy(key).agg(*first or [F.lit(None).alias("near")])
    numbered = number_rows(stage(known, "keys"), [*(["near"] if near else []), key], "id")
    return stage(numbered.select(key, "id"), "dense-ids")


def piece(number: str | Column) -> Column:
    return F.bitmap_bucket_number(number)


def bitmaps(rows: DataFrame, by: Sequence[str], number: str = "id") -> DataFrame:
    """(by, piece, bits): which numbers each group holds. Nulls are left out. A bit is set once for
    however many rows, in the task that reads them, so a hot group costs its pieces per task."""
    bits = rows.where(F.col(number).isNotNull()).select(
        *by, piece(number).alias("piece"), F.bitmap_bit_position(number).alias("_bit"))
    return bits.groupBy(*by, "piece").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def merged(stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups: those of ``stored`` that agree in ``by``, united."""
    return stored.groupBy(*by, "piece").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(stored: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    """(by, name): how many distinct numbers the bitmaps of each group hold together."""
    return (merged(stored, by).groupBy(*by)
            .agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias(name)))
