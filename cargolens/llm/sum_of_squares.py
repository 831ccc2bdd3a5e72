"""Packing into sequences by the sum-of-squares rule.

An item goes where it leaves the sum, over all gaps, of the squared number of open sequences
with that gap smallest; a new sequence is one of the choices. Equal choices go to the smallest
gap, and to an open sequence rather than a new one. The rule keeps sequences of all gaps at
hand, so what it wastes grows more slowly than what it packs: parts of tens of thousands of
items are packed apart from each other, each in one task, at next to no loss.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cargolens.llm.common import small_batches
from cargolens.llm.tokens import token_pieces
from cargolens.session import stage

PART_ITEMS = 50_000
# Shares of the smallest items kept for the end, largest first. Gaps left by the others in the
# order they come are filled with them; which share leaves the fewest sequences differs.
LAST_SHARES = (0.1, 0.3, 0.7, 1.0)


def place(lengths: np.ndarray, order: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence (from 0) and offset of each length, placed in ``order``."""
    open_with = np.zeros(capacity + 1, np.int64)     # open sequences by gap
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    never = np.int64(1) << 62
    opened = 0
    for k in order:
        size = int(lengths[k])
        gap, least = capacity, never
        if size < capacity:
            have = open_with[size:capacity]
            change = np.where(have > 0, 2 * open_with[:capacity - size] - 2 * have + 2, never)
            if have[0]:
                change[0] -= 1                       # closes it: no gap is left to count
            at = int(change.argmin())
            least, gap = change[at], size + at
        if least <= (2 * open_with[capacity - size] + 1 if size < capacity else 0):
            chosen = stacks[gap].pop()
            open_with[gap] -= 1
        else:
            chosen, gap = opened, capacity
            opened += 1
        sequence[k], offset[k] = chosen, capacity - gap
        if gap > size:
            open_with[gap - size] += 1
            stacks[gap - size].append(chosen)
    return sequence, offset


def pack_part(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The best of a few orders, each placed by the rule."""
    fewest = -(-int(lengths.sum()) // capacity)
    by_size = np.argsort(-lengths, kind="stable")
    best = None
    for share in LAST_SHARES:
        last = by_size[len(by_size) - round(share * len(by_size)):]
        first = np.ones(len(lengths), bool)
        first[last] = False
        found = place(lengths, np.concatenate([np.flatnonzero(first), last]), capacity)
        if best is None or found[0].max() < best[0].max():
            best = found
        if best[0].max() + 1 == fewest:
            break
    return best


def pack(items: DataFrame, capacity: int = 4096, part_items: int = PART_ITEMS) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``; ``length`` is 1 to ``capacity``.

    Items are stored with a number and dealt to parts by it, so equal rows spread and reruns
    over the stored rows agree. Only numbers and lengths go through the packing. Columns of
    ``items`` may be null but for ``length``, and have any name but the two added.
    """
    small_batches(items.sparkSession)
    stored = stage(items.withColumn("__item", F.monotonically_increasing_id()), "pack-items")
    parts = max(1, -(-stored.count() // part_items))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("__item")
        sequence, offset = pack_part(part["length"].to_numpy(), capacity)
        return pd.DataFrame({"__packed": part["__item"], "offset": offset,
                             "sequence_id": (part["__part"].to_numpy() << 32) + sequence})

    packed = (stored.select("__item", F.col("length").cast("long").alias("length"),
                            F.pmod(F.xxhash64("__item"), F.lit(parts)).alias("__part"))
              .groupBy("__part").applyInPandas(run, "__packed long, offset long, sequence_id long"))
    return (stored.join(packed, F.col("__item") == F.col("__packed"))
            .select(*items.columns, "sequence_id", "offset"))


def packed_documents(docs: DataFrame, capacity: int = 4096) -> DataFrame:
    """Pieces of all texts with their place: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. The ids themselves are left out; ``pack(token_pieces(docs))`` has them."""
    pieces = token_pieces(docs, capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(pieces, capacity)
