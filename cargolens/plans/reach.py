"""Approximate distinct products as stored sketches: any period from one small row an hour.

A HyperLogLog sketch of 2^LG_K registers estimates a distinct count with a standard error of
about 1.04 / sqrt(2^LG_K). Sketches unite without loss: the union of the hours' sketches is the sketch
over all hits of those hours. So the hits are read once, and a day, a month or an hour of the day
comes from what is stored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cargolens.session import stage

LG_K = 14


def standard_error(lg_k: int = LG_K) -> float:
    """Relative, for counts that are large against 2^lg_k; smaller counts are closer to the truth."""
    return 1.04 / math.sqrt(2 ** lg_k)


def hourly_reach(hits: DataFrame, what: str, time: str = "date", by: Sequence[str] = (),
                 lg_k: int = LG_K) -> DataFrame:
    """Stored rows (by, hour_start, hits, sketch) of the hits that have a time; ``what`` is the text or
    BIGINT column to count, its nulls are hits only."""
    hour = F.date_trunc("hour", F.col(time)).cast("timestamp_ntz")
    rows = hits.where(F.col(time).isNotNull()).groupBy(*by, hour.alias("hour_start")).agg(
        F.count("*").alias("hits"), F.hll_sketch_agg(what, lg_k).alias("sketch"))
    return stage(rows, "hourly-reach")


def reach(stored: DataFrame, by: Sequence[Column | str] = ()) -> DataFrame:
    """(by, hits, distinct_estimate) of coarser groups than those stored."""
    return stored.groupBy(*by).agg(
        F.sum("hits").alias("hits"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))
