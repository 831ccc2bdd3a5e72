"""Near-duplicate detection by SimHash, with a byte-position inverted index and a count filter.

Fingerprints that differ in at most d bits differ in at most d of their 8 bytes, so they share at
least 8 - d positional bytes (six for d = 2). Tallying the lists of single bytes pair by pair would
bring up every pair of fingerprints with one byte in common, a square of the corpus. The lists are
therefore intersected while they are built: each list belongs to 8 - d positions and the bytes
there, and a pair with s shared bytes meets in C(s, 8 - d) of the C(8, d) lists of a fingerprint, in
none below the minimum. Inside a list the tally goes on over the d free bytes, and what reaches the
minimum is verified by counting bits.

A list holds distinct fingerprints that differ only in d bytes, 256^d at most whatever the corpus
is, so one task bears it. It isn't expanded into pairs: each member looks up the members within d
bits among the free ones, and only links that join parts of the list leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cargolens.llm.common import small_batches, text_bytes
from cargolens.llm.components import components
from cargolens.session import stage

BYTES = 8
STEP = 1 << 16      # shingles hashed at a time
MEMBERS = 4096      # members of a list looked up at a time


@dataclass(frozen=True)
class Plan:
    shingle: int = 3
    distance: int = 2       # link at so many differing bits, or fewer
    seed: int = 42

    @property
    def shared(self) -> int:
        """Positional bytes that two linked fingerprints share at least."""
        return BYTES - self.distance

    @property
    def free(self) -> list[tuple[int, ...]]:
        """The positions that each kind of list leaves open."""
        return list(combinations(range(BYTES), self.distance))


def _fingerprint(words: list[bytes], plan: Plan) -> int:
    size = min(plan.shingle, len(words))
    if not size:
        return 0
    count = len(words) - size + 1
    shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(size))))
    ones = np.zeros(64, np.int64)
    for start in range(0, count, STEP):
        part = islice(shingles, STEP)
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, plan.seed) for s in part), "<u8",
                             min(STEP, count - start))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """(doc_id, fingerprint long) of every row; 0 for a text without words, or null."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_fingerprint(text.lower().split(), plan)  # bytes: ASCII letters and space only
                     for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())],
                                             names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), text_bytes("text").alias("text")).mapInArrow(
        run, "doc_id long, fingerprint long")


def _byte_mask(positions: tuple[int, ...]) -> int:
    return sum(0xFF << (8 * p) for p in positions)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def index_lists(nodes: DataFrame, plan: Plan) -> DataFrame:
    """(free, members): the lists with more than one member. ``free`` numbers the positions that
    are left open, ``members`` are the fingerprints that agree in all others."""
    every = (1 << 64) - 1
    fixed = F.array(*[F.col("fingerprint").bitwiseAND(F.lit(_signed(every ^ _byte_mask(p))))
                      for p in plan.free])
    entries = nodes.select("fingerprint", F.posexplode(fixed).alias("free", "bytes"))
    return (entries.groupBy("free", "bytes").agg(F.collect_list("fingerprint").alias("members"))
            .where(F.size("members") > 1).select("free", "members"))


def _near(free: tuple[int, ...], distance: int) -> np.ndarray:
    """What may differ: every choice of up to ``distance`` bits of the free bytes."""
    bits = [1 << (8 * p + k) for p in free for k in range(8)]
    return np.array([sum(c) for n in range(1, distance + 1) for c in combinations(bits, n)], np.uint64)


def _meetings(members: np.ndarray, near: np.ndarray) -> Iterator[tuple[int, int]]:
    """Places (i, j) of members within the distance, i < j in the order of ``members``."""
    for start in range(0, len(members), MEMBERS):
        part = members[start:start + MEMBERS, None]
        asked = part ^ near[None, :]
        at = np.minimum(np.searchsorted(members, asked), len(members) - 1)
        row, column = np.nonzero((members[at] == asked) & (asked > part))
        yield from zip((row + start).tolist(), at[row, column].tolist())


def _joining(members: np.ndarray, near: np.ndarray) -> Iterator[tuple[int, int]]:
    """Those meetings that join two parts of the list that were apart so far."""
    above = list(range(len(members)))

    def top(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    for i, j in _meetings(members, near):
        a, b = top(i), top(j)
        if a != b:
            above[max(a, b)] = min(a, b)
            yield i, j


def shared_bytes(a: Column | str, b: Column | str) -> Column:
    """How many of the 8 positional bytes of two fingerprints are equal."""
    differing = F.col(a).bitwiseXOR(F.col(b)) if isinstance(a, str) else a.bitwiseXOR(b)
    return sum(((differing.bitwiseAND(F.lit(_signed(_byte_mask((p,))))) == 0).cast("int")
                for p in range(BYTES)), F.lit(0))


def links(nodes: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Links (a, b) among distinct fingerprints that connect all that lie within the distance of
    each other, directly or by way of others."""
    kinds = plan.free

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = [_near(free, plan.distance) for free in kinds]
        for batch in batches:
            a, b = [], []
            for free, members in zip(batch.column(0).to_pylist(), batch.column(1)):
                members = np.sort(np.asarray(members.values).view(np.uint64))
                pairs = list(_joining(members, near[free]))
                ends = members[np.array(pairs, np.int64).reshape(-1, 2)].view(np.int64)
                a.append(ends[:, 0])
                b.append(ends[:, 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()) for x in (a, b)],
                names=["a", "b"])

    pairs = index_lists(nodes, plan).mapInArrow(run, "a long, b long").distinct()
    counted = pairs.withColumn("shared", shared_bytes("a", "b")).where(F.col("shared") >= plan.shared)
    return counted.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= plan.distance).select("a", "b")


def near_duplicates(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (long), component_id (the smallest doc_id
    among all it is linked with, directly or not), kept (it is that document).

    Words are split at ASCII white space, A-Z lower-cased; shingles count as often as they occur,
    fewer words than a shingle are one shingle. A text without words, or null, has fingerprint 0
    and is linked like any other. Equal fingerprints are one node, so copies cost nothing more. A
    null doc_id is the smallest of its component only if there is no other. Other columns are not
    read.
    """
    found = stage(fingerprints(docs, plan), "simhash-fingerprints")
    nodes = stage(found.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")), "simhash-nodes")
    labels = components(stage(links(nodes, plan), "simhash-links"))
    labelled = stage(nodes.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
                     .withColumn("component", F.coalesce("component", "fingerprint")), "simhash-labels")
    low = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    groups = stage(labelled.join(low, "component").select("fingerprint", "component_id"), "simhash-groups")
    return (found.join(groups, "fingerprint").select("doc_id", "fingerprint", "component_id")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def hex_digits(fingerprint: Column | str) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")
