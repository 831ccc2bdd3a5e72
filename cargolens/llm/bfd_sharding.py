"""Sharding of indivisible groups by best-fit decreasing.

Groups, largest first, enter the open bin with the tightest remaining capacity that still holds
them, found in a balanced tree of the remaining capacities. That is done twice. Hash parts of
the groups are packed at the same time into small bins, each a few thousandths of a shard; the
small bins, a number that the shards fix and not the data, are then packed into the shards. A
fixed capacity is met to within the last small bin, and of all capacities the smallest is taken
that needs no more than the wanted shards. A group above an even share has a shard to itself, and
the capacity of the other shards is searched without it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from cargolens.llm.common import small_batches, text_bytes
from cargolens.operators.row_numbers import number_rows
from cargolens.session import stage

BINS_A_SHARD = 512      # small bins to a shard, before what the parts leave half full
PART_GROUPS = 100_000   # groups that one task packs
NEAR = 0.005            # loads that differ by no more of an even share are near equal


class GapTree:
    """Remaining capacities of bins: a treap, balanced by hashed priorities, so equal on reruns."""

    def __init__(self) -> None:
        self.root: list | None = None   # [key, priority, left, right], key = (gap, bin)

    def add(self, gap: int, name: int) -> None:
        key = (gap, name)
        priority = xxhash.xxh3_64_intdigest(repr(key).encode())
        path, node = [], self.root
        while node is not None and node[1] > priority:
            path.append((node, 3 if key > node[0] else 2))
            node = node[path[-1][1]]
        left, right = self._cut(node, key)
        self._hang(path, [key, priority, left, right])

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the smallest (gap, bin) with ``gap >= size``."""
        path, node, found = [], self.root, None
        while node is not None:
            if node[0][0] >= size:
                found = len(path)
                path.append((node, 2))
                node = node[2]
            else:
                path.append((node, 3))
                node = node[3]
        if found is None:
            return None
        key = path[found][0][0]
        self._hang(path[:found], self._joined(path[found][0][2], path[found][0][3]))
        return key

    def _hang(self, path: list, node: list | None) -> None:
        if path:
            path[-1][0][path[-1][1]] = node
        else:
            self.root = node

    @staticmethod
    def _cut(node: list | None, key: tuple) -> tuple:
        """The parts of a tree below and above a key."""
        ends = [None, None, None, None]          # results at 3 (below) and 2 (above)
        low, high = ends, ends
        while node is not None:
            if node[0] < key:
                low[3], low, node = node, node, node[3]
            else:
                high[2], high, node = node, node, node[2]
        low[3], high[2] = (None if low is not ends else ends[3]), (None if high is not ends else ends[2])
        return ends[3], ends[2]

    @staticmethod
    def _joined(left: list | None, right: list | None) -> list | None:
        top = [None, None, None, None]
        at, side = top, 3
        while left is not None and right is not None:
            if left[1] > right[1]:
                at[side], at, side, left = left, left, 3, left[3]
            else:
                at[side], at, side, right = right, right, 2, right[2]
        at[side] = left if left is not None else right
        return top[3]


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin (from 0) of each size; one above the capacity has a bin to itself."""
    tree, bins, opened = GapTree(), np.empty(len(sizes), np.int64), 0
    for k in np.argsort(-sizes, kind="stable"):
        size = int(sizes[k])
        gap, chosen = tree.take_tightest(size) or (capacity, -1)
        if chosen < 0:
            chosen, opened = opened, opened + 1
        bins[k] = chosen
        if gap > size:
            tree.add(gap - size, chosen)
    return bins


def fewest_capacity(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Bins at the smallest capacity found that needs at most ``shards``."""
    if not len(sizes):
        return np.empty(0, np.int64)
    low = max(-(-int(sizes.sum()) // shards), int(sizes.max()))
    high, best = low, None
    while (bins := best_fit_decreasing(sizes, high)).max() >= shards:
        low, high = high + 1, high + max(1, high >> 10)
    best = bins
    while low < high:
        middle = (low + high) // 2
        bins = best_fit_decreasing(sizes, middle)
        if bins.max() < shards:
            best, high = bins, middle
        else:
            low = middle + 1
    return best


def above_even(sizes: list[int], total: int, shards: int) -> int:
    """How many of the largest ``sizes`` (descending) are each above the even share of what the
    larger ones leave; always fewer than ``shards``."""
    count = 0
    while count < len(sizes) and sizes[count] * (shards - count) > total:
        total -= sizes[count]
        count += 1
    return count


def even_bins(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each size, with loads as near to equal as whole sizes allow.

    A size above the even share of what is left is alone. The others are packed at the smallest
    capacity; if that leaves the loads apart, as sizes near the capacity do, the fullest shard is
    closed and the rest packed anew over the other shards, so none stays empty for another's size.
    """
    out = np.empty(len(sizes), np.int64)
    left = np.argsort(-sizes, kind="stable")
    first = above_even(sizes[left[:shards]].tolist(), int(sizes.sum()), shards)
    out[left[:first]] = np.arange(first)
    left = left[first:]
    while len(left):
        rest = sizes[left]
        bins = fewest_capacity(rest, shards - first)
        loads = np.bincount(bins, rest, shards - first)
        if np.ptp(loads) <= NEAR * loads.mean():
            out[left] = first + bins
            break
        fullest = bins == loads.argmax()
        out[left[fullest]] = first
        left, first = left[~fullest], first + 1
    return out


def shard_groups(groups: DataFrame, shards: int, part_groups: int = PART_GROUPS) -> DataFrame:
    """(key, shard) for stored ``groups`` (key, bytes)."""
    small_batches(groups.sparkSession)
    total, count = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    largest = [r["bytes"] for r in groups.select("bytes").orderBy(F.desc("bytes")).limit(shards).collect()]
    alone = above_even(largest, total, shards)   # their shards need no small bins
    capacity = max(1, -(-(total - sum(largest[:alone])) // ((shards - alone) * BINS_A_SHARD)))
    parts = max(1, -(-count // part_groups))

    def pack_part(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key")
        bins = best_fit_decreasing(rows["bytes"].to_numpy(), capacity)
        return pd.DataFrame({"key": rows["key"], "bytes": rows["bytes"],
                             "bin": (rows["part"].to_numpy() << 32) + bins})

    packed = stage(groups.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)))
                   .groupBy("part").applyInPandas(pack_part, "key binary, bytes long, bin long"),
                   "shard-bins")

    def pack_bins(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("bin")
        return pd.DataFrame({"__bin": rows["bin"],
                             "shard": even_bins(rows["bytes"].to_numpy(), shards)})

    bins = packed.groupBy("bin").agg(F.sum("bytes").alias("bytes"))
    placed = stage(bins.withColumn("all", F.lit(1)).groupBy("all")
                   .applyInPandas(pack_bins, "__bin long, shard int"),
                   "shard-places")
    return packed.join(placed, F.col("bin") == F.col("__bin")).select("key", "shard")


def shard_documents(docs: DataFrame, shards: int = 8, part_groups: int = PART_GROUPS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot.

    Rows with equal texts stay together, and null counts as the empty text; a size is the UTF-8
    bytes and 1. No group is ever split, so one larger than an even share has a shard to itself, which
    is larger; the other shards are near equal to each other.
    ``slot`` numbers a shard's rows by doc_id, then size, nulls first. A null doc_id and repeated
    rows are rows like others; other columns are not read.
    """
    text = text_bytes("text")
    rows = stage(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                             F.crc32(text).alias("text_crc32"),
                             F.unhex(F.sha2(text, 256)).alias("key")), "shard-rows")
    groups = stage(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "shard-groups")
    placed = shard_groups(groups, shards, part_groups)
    sharded = stage(rows.join(placed, "key").select("doc_id", "size", "text_crc32", "shard"),
                    "shard-rows")
    return number_rows(sharded, ["doc_id", "size"], "slot", by=["shard"])
