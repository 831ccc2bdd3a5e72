"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

The documents of each source are hashed into blocks. A source's target is filled with whole
blocks, as often as it takes and each at most ``most`` times: its quota. The quotas of all
sources are then split among the output shards down a binary tree; at each node the left half's
share of every source is drawn from the multivariate hypergeometric distribution, the right half
gets the rest, so the leaves' quotas are exact and sum to the whole. Each shard takes its quota
from the source's permuted blocks, disjoint from the other shards', and its documents are
shuffled within it. Every draw is seeded, so reruns agree.

What the driver sees is a few numbers for each source, never more than ``MAX_SOURCES``.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from cargolens.llm.common import SPACE, small_batches
from cargolens.session import stage

MAX_SOURCES = 20_000        # a mix names its sources; more than this is refused
PERMUTATIONS = 64
BROADCAST_DRAWS = 200_000   # rows of (source, block, shard) that are sent to every task


@dataclass(frozen=True)
class Mix:
    blocks: int = 1024      # of each source: how finely a target can be met
    shards: int = 64
    most: int = 3           # times that a document may be taken
    weights: tuple[int, ...] = (1, 2, 3)   # of the sources by code point, repeating, null last
    seed: int = 17


def targets(sizes: list[int], weights: list[int], most: int) -> list[Fraction]:
    """Shares of the total by weight, none above ``most`` times its size; what is cut off goes to
    the others by weight, until none is above."""
    left, free, out = Fraction(sum(sizes)), set(range(len(sizes))), [Fraction(0)] * len(sizes)
    while free:
        unit = left / sum(weights[k] for k in free)
        full = [k for k in free if unit * weights[k] > most * sizes[k]]
        for k in full or free:
            out[k] = Fraction(most * sizes[k]) if full else unit * weights[k]
        if not full:
            break
        left -= sum(out[k] for k in full)
        free -= set(full)
    return out


def _order(seed: int, *keys: int) -> int:
    return xxhash.xxh3_64_intdigest(b"".join(int(k).to_bytes(8, "little", signed=True) for k in keys),
                                    seed)


def choose_blocks(words: np.ndarray, blocks: np.ndarray, target: Fraction, seed: int
                  ) -> list[tuple[int, int]]:
    """(block, pass) tickets whose words come near to ``target``: whole passes, then the blocks of
    a permutation that still fit. Permutations are tried until one is within a thousandth, or the
    nearest of ``PERMUTATIONS`` is taken; only a source of a few documents needs more than one."""
    total = int(words.sum())
    if not total:
        return []
    full = int(target // total)
    least, best = None, []
    for attempt in range(PERMUTATIONS):
        left, chosen, smallest = target - full * total, [], None
        for k in sorted(range(len(blocks)), key=lambda k: _order(seed, blocks[k], full, attempt)):
            if words[k] <= left:
                left -= int(words[k])
                chosen.append((int(blocks[k]), full))
            elif smallest is None or words[k] < words[smallest]:
                smallest = k
        if smallest is not None and words[smallest] < 2 * left:
            left -= int(words[smallest])
            chosen.append((int(blocks[smallest]), full))
        if least is None or abs(left) < least:
            least, best = abs(left), chosen
        if 1000 * least <= target:
            break
    return [(int(b), p) for p in range(full) for b in blocks] + best


def split(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Exact quotas (shard, source) of the leaves of the splitting tree."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    total = int(quotas.sum())
    random = np.random.default_rng([seed, shards, total])
    drawn = random.multivariate_hypergeometric(quotas, total * left // shards, method="marginals")
    return np.concatenate([split(drawn, left, 2 * seed + 1),
                           split(quotas - drawn, shards - left, 2 * seed + 2)])


def sized_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__size``, the number of words of the text (null: 0)."""
    count = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(f"[^{SPACE}]+"))
    return docs.withColumn("__size", count.cast("long"))


def _block(plan: Mix):
    return F.pmod(F.xxhash64(F.lit(plan.seed), "doc_id", "__size"), F.lit(plan.blocks)).cast("int")


def draws(sized: DataFrame, plan: Mix = Mix()) -> tuple[DataFrame, DataFrame]:
    """What the mix takes, (source, block, pass, shard), and (source, source_size, target).

    ``sized``: source, __size, __block; stored, as it is read twice. Only sums for each source
    and block leave it, so a hot source is a row for each task and block.
    """
    spark = small_batches(sized.sparkSession)
    per_source = (sized.groupBy("source").agg(F.sum("__size").alias("size"))
                  .limit(MAX_SOURCES + 1).collect())
    if len(per_source) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    per_source.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    names = [r["source"] for r in per_source]
    sizes = [int(r["size"]) for r in per_source]
    weights = [plan.weights[k % len(plan.weights)] for k in range(len(names))]
    goals = targets(sizes, weights, plan.most) if names else []
    number = {name: k for k, name in enumerate(names)}

    def choose(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        k = number[key[0]]
        tickets = choose_blocks(rows["words"].to_numpy(), rows["block"].to_numpy(), goals[k],
                                plan.seed + k)
        tickets.sort(key=lambda t: _order(plan.seed, k, *t))
        return pd.DataFrame({"source": key[0], "block": [b for b, _ in tickets],
                             "pass": [p for _, p in tickets], "at": range(len(tickets)),
                             "number": k})

    by_block = (sized.groupBy("source", F.col("__block").alias("block"))
                .agg(F.sum("__size").alias("words")))
    tickets = stage(by_block.groupBy("source").applyInPandas(
        choose, "source string, block int, pass int, at int, number int"), "mix-tickets")
    quotas = np.zeros(len(names), np.int64)
    for row in tickets.groupBy("number").count().collect():
        quotas[row["number"]] = row["count"]
    ends = np.cumsum(split(quotas, plan.shards, plan.seed), axis=0)  # of each shard, by source

    def deal(batches):
        for rows in batches:
            rows["shard"] = [int(np.searchsorted(ends[:, k], at, side="right"))
                             for k, at in zip(rows["number"], rows["at"])]
            yield rows[["source", "block", "pass", "shard"]]

    dealt = tickets.mapInPandas(deal, "source string, block int, pass int, shard int")
    goal_rows = spark.createDataFrame(
        [(n, s, float(g)) for n, s, g in zip(names, sizes, goals)],
        "source string, source_size long, target double")
    return stage(dealt, "mix-draws"), goal_rows


def mix(docs: DataFrame, plan: Mix = Mix()) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it does, with ``__shard`` and
    ``__place``, the key of the shuffle within the shard.

    A source may be null, and is then its own source. A null text has no words: it is dealt with
    its block, at no cost. Rows equal in doc_id and size are in one block and are taken alike.
    A source without words has target 0 and nothing is taken.
    """
    rows = sized_rows(docs).withColumn("__block", _block(plan))
    taken, _ = draws(stage(rows.select("source", "__size", "__block"), "mix-sizes"), plan)
    return _drawn(rows, taken, plan).drop("__size", "__block", "__pass")


def _drawn(rows: DataFrame, taken: DataFrame, plan: Mix) -> DataFrame:
    taken = taken.select(F.col("source").alias("__source"), F.col("block").alias("__drawn"),
                         F.col("pass").alias("__pass"), F.col("shard").alias("__shard"))
    if taken.count() <= BROADCAST_DRAWS:
        taken = F.broadcast(taken)
    return (rows.join(taken, (F.col("__block") == F.col("__drawn"))
                      & F.col("source").eqNullSafe(F.col("__source")))
            .drop("__source", "__drawn")
            .withColumn("__place", F.xxhash64(F.lit(plan.seed), "doc_id", "__pass")))


def in_order(mixed: DataFrame) -> DataFrame:
    """Rows sorted by shard and shuffled within it, across the cluster; helper columns go."""
    return (mixed.repartitionByRange("__shard", "__place").sortWithinPartitions("__shard", "__place")
            .drop("__shard", "__place"))


def taken_words(docs: DataFrame, plan: Mix = Mix()) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target (of its source), taken (words
    the mix takes of it, repeats counted) and ``shards`` (in how many shards it lies)."""
    sized = stage(sized_rows(docs.select("doc_id", "source", "text"))
                  .select("doc_id", "source", "__size").withColumn("__block", _block(plan))
                  .withColumn("__row", F.monotonically_increasing_id()), "mix-sizes")
    taken, goals = draws(sized, plan)
    mixed = _drawn(sized, taken, plan).groupBy(F.col("__row").alias("__taken_row")).agg(
        F.sum("__size").alias("taken"), F.countDistinct("__shard").alias("shards"))
    goals = goals.withColumnRenamed("source", "__source")
    return (sized.join(goals, F.col("source").eqNullSafe(F.col("__source")))
            .join(mixed, F.col("__row") == F.col("__taken_row"), "left")
            .select("doc_id", F.col("__size").alias("size"), "source_size", "target",
                    F.coalesce("taken", F.lit(0)).alias("taken"),
                    F.coalesce("shards", F.lit(0)).alias("shards")))
