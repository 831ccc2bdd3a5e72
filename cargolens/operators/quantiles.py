"""Exact quantiles of many columns without gathering a column in one task.

``percentile`` keeps every distinct value of a group in one task and a global sort moves every
row. Here a bounded sample brackets the wanted ranks; one more pass counts what lies outside the
brackets and stores what lies inside, value by value; the stored rest, a few hundredths of the
rows at most, is sorted by range and counted to the rank. A sample can't change a result: the counts
say whether a bracket holds its rank, and one that doesn't is taken wider. With the pass that
takes the ends of each column these are three passes, however the values are spread.

Like ``DataFrame.approxQuantile`` this runs at once and returns plain lists. What comes to the
driver is a row for each column and for each rank. Stage a frame that is costly.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from cargolens.functions.numbers import nan_to_null
from cargolens.operators.row_numbers import PARTITION_SHIFT
from cargolens.session import stage

SAMPLE = 1 << 17    # rows that bracket the ranks, about
SLOTS = 2000        # the sample's sketch tells the rank of a value to one of so many parts
DEVIATIONS = 5      # a bracket misses its rank by chance once in a million


def as_double(c: str) -> Column:
    """A column as DOUBLE, NaN being missing."""
    return nan_to_null(F.col(c).cast("double"))


def unpivot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (i, v): position and DOUBLE value of every cell that isn't missing."""
    if not columns:
        return df.sparkSession.createDataFrame([], "i INT, v DOUBLE")
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), as_double(c).alias("v"))
        for i, c in enumerate(columns)])).alias("t")).select("t.*").where("v is not null")


# --- brackets from a sample -------------------------------------------------------

def spread_columns() -> list[Column]:
    """Aggregates of the rows of ``unpivot``, by ``i``, that ``exact_quantiles`` starts from."""
    return [F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")]


def _inner(probabilities: Sequence[float]) -> list[float]:
    return sorted({p for p in probabilities if 0 < p < 1})


def _margins() -> list[float]:
    """Distances from a wanted share at which the sample is asked, up to all of a column."""
    first = 2.0 / SLOTS
    return [first * 1.5 ** k for k in range(math.ceil(math.log(max(1 / first, 1), 1.5)) + 1)]


def _sketches(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
              share: float) -> dict[int, tuple[int, list[float]]]:
    """For each column its values in the sample and, for each wanted share and margin, the value
    that far below and above the share."""
    asked = [min(max(p + side * m, 0.0), 1.0) for p in _inner(probabilities) for m in _margins()
             for side in (-1, 1)]
    rows = df.sample(False, share, 11) if share < 1 else df
    found = unpivot(rows, columns).groupBy("i").agg(
        F.count("*").alias("n"), F.percentile_approx("v", asked, SLOTS).alias("sketch"))
    return {r["i"]: (r["n"], r["sketch"]) for r in found.collect()}


@dataclass
class _Bracket:
    """Values of column ``i`` in [lo, hi]; ``before`` others lie below."""

    i: int
    lo: float
    hi: float
    before: int = 0
    n: int = 0

    def holds(self, at: int) -> bool:
        return self.before <= at < self.before + self.n


def _ranks(n: int, p: float) -> tuple[int, int]:
    """The two ranks, from 0, between which the quantile of ``n`` values lies."""
    at = math.floor(p * (n - 1))
    return at, min(at + 1, n - 1)


def _bracketed(i: int, stats: Mapping, sampled: tuple[int, list[float]] | None,
               probabilities: Sequence[float]) -> list[_Bracket]:
    """Disjoint brackets, ascending, that should hold the ranks of column ``i``."""
    margins = _margins()
    found: list[_Bracket] = []
    for k, p in enumerate(_inner(probabilities)):
        lo, hi = stats["lo"], stats["hi"]
        if sampled:
            n, sketch = sampled
            # The second part is for shares so small that a sample has only a few values there.
            chance = DEVIATIONS * math.sqrt(p * (1 - p) / n) + DEVIATIONS ** 2 / n if n < stats["n"] else 0
            wide = chance + 2 / SLOTS + 2 / n
            pick = next((j for j, m in enumerate(margins) if m >= wide), None)
            if pick is not None:
                place = 2 * (k * len(margins) + pick)
                # The ends of the column may lie outside those of the sample.
                lo = sketch[place] if p - margins[pick] > 0 else lo
                hi = sketch[place + 1] if p + margins[pick] < 1 else hi
        if found and lo <= found[-1].hi:
            found[-1].hi = max(found[-1].hi, hi)
        else:
            found.append(_Bracket(i, lo, hi))
    return found


# --- what lies inside -------------------------------------------------------------

def _inside(df: DataFrame, columns: Sequence[str], brackets: list[_Bracket]) -> DataFrame:
    """Stored rows (i, region, v, n) of one pass: regions 0, 2, ... lie outside the column's brackets
    and have one count each, regions 1, 3, ... inside, with a count for each value."""
    of_column = {i: [b for b in brackets if b.i == i] for i in {b.i for b in brackets}}
    ends: dict[str, list] = {"lo": [], "hi": []}
    most = max(len(x) for x in of_column.values())
    for side, table in ends.items():
        for k in range(most):
            table.append(F.array(*[F.lit(getattr(of_column[i][k], side) if k < len(of_column.get(i, []))
                                         else None).cast("double") for i in range(len(columns))]))
    i, v = F.col("i"), F.col("v")
    region = sum((F.coalesce((v >= lo[i]).cast("int"), F.lit(0)) + F.coalesce((v > hi[i]).cast("int"), F.lit(0))
                  for lo, hi in zip(ends["lo"], ends["hi"])), F.lit(0))
    cells = unpivot(df, columns).where(i.isin(list(of_column))).withColumn("region", region)
    kept = F.when(F.col("region") % 2 == 1, v)
    return stage(cells.groupBy("i", "region", kept.alias("v")).agg(F.count("*").alias("n")), "quantile-rest")


def _count(rest: DataFrame, brackets: list[_Bracket]) -> None:
    """Fill in how many values lie below and inside each bracket."""
    counts = {(r["i"], r["region"]): r["n"] for r in
              rest.groupBy("i", "region").agg(F.sum("n").alias("n")).collect()}
    region: dict[int, int] = {}
    for b in brackets:
        region[b.i] = own = region.get(b.i, -1) + 2
        b.before = sum(counts.get((b.i, r), 0) for r in range(own))
        b.n = counts.get((b.i, own), 0)


def _select(rest: DataFrame, wanted: set[tuple[int, int, int]]) -> dict[tuple[int, int, int], float]:
    """The values at the ``wanted`` places (i, region, place among the region's values)."""
    if not wanted:
        return {}
    keys = ["i", "region", "v"]
    placed = stage(rest.where("v is not null").repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .withColumn("part", F.shiftright(F.monotonically_increasing_id(), PARTITION_SHIFT)),
                   "quantile-order")
    by = ["i", "region"]
    totals = placed.groupBy("part", *by).agg(F.sum("n").alias("total"))
    before = F.sum("total").over(Window.partitionBy(*by).orderBy("part")
                                 .rowsBetween(Window.unboundedPreceding, -1))
    asked = rest.sparkSession.createDataFrame(sorted(wanted), "i INT, region INT, at BIGINT")
    # One row for each stored part, and of the parts only those that hold a wanted place.
    totals = totals.withColumn("before", F.coalesce(before, F.lit(0)))
    here = totals.join(asked, by).where("before <= at AND at < before + total")
    running = F.sum("n").over(Window.partitionBy("part", *by).orderBy("v")
                              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = (placed.join(here.select("part", *by, "before").distinct(), ["part", *by])
             .withColumn("upto", F.col("before") + running).join(asked, by)
             .where("upto - n <= at AND at < upto").select("i", "region", "at", "v"))
    return {(r["i"], r["region"], r["at"]): r["v"] for r in found.collect()}


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                    stats: Mapping[str, Mapping] | None = None) -> dict[str, list[float] | None]:
    """Quantiles per column, interpolated linearly; None for a column without values.

    Nulls and NaN are ignored. ``stats`` has the ``spread_columns`` of each column that has
    values, where another aggregate has taken them already.
    """
    if stats is None:
        rows = unpivot(df, columns).groupBy("i").agg(*spread_columns()).collect()
        stats = {columns[r["i"]]: r for r in rows}
    known: dict[tuple[int, int], float] = {}      # (column, rank) -> value
    ranks: dict[int, set[int]] = {}
    for i, c in enumerate(columns):
        if c not in stats:
            continue
        s = stats[c]
        known |= {(i, 0): s["lo"], (i, s["n"] - 1): s["hi"]}
        ranks[i] = {at for p in probabilities for at in _ranks(s["n"], p)} - {0, s["n"] - 1}
        if s["lo"] == s["hi"]:
            known |= {(i, at): s["lo"] for at in ranks.pop(i)}
    brackets = []
    if wide := [i for i in ranks if ranks[i]]:
        sampled = _sketches(df, columns, probabilities, SAMPLE / max(stats[columns[i]]["n"] for i in wide))
        brackets = [b for i in wide for b in _bracketed(i, stats[columns[i]], sampled.get(i), probabilities)]
    while brackets:
        rest = _inside(df, columns, brackets)
        _count(rest, brackets)
        wanted, at_rank, missed = set(), {}, set()
        for i in {b.i for b in brackets}:
            mine = [b for b in brackets if b.i == i]
            for at in ranks[i]:
                k = next((k for k, b in enumerate(mine) if b.holds(at)), None)
                if k is None:
                    missed.add(i)
                    continue
                place = (i, 2 * k + 1, at - mine[k].before)
                wanted.add(place)
                at_rank[place] = (i, at)
        known |= {at_rank[place]: v for place, v in _select(rest, wanted).items()}
        # A column of which a bracket missed its rank is taken whole.
        brackets = [_Bracket(i, stats[columns[i]]["lo"], stats[columns[i]]["hi"]) for i in missed]

    def value(i: int, n: int, p: float) -> float:
        position = p * (n - 1)
        low, high = _ranks(n, p)
        v0, v1 = known[i, low], known[i, high]
        return v0 if v0 == v1 else v0 + (v1 - v0) * (position - low)

    return {c: [value(i, stats[c]["n"], p) for p in probabilities] if c in stats else None
            for i, c in enumerate(columns)}
