"""Near-duplicate detection with b-bit MinHash.

One scan takes the minima of every document's shingles. Groups of minima (bands) give the
candidate buckets; of each minimum, mixed, only its low bits are kept, packed into a few longs, and
the share of equal low bits, corrected for chance, estimates the similarity of a candidate pair.
Pairs that may reach the threshold are confirmed on the full shingle sets.

Buckets are not expanded into pairs. Each bucket is compared with its hub, the member that
shares most buckets with others, and linked members need no further test among themselves; what
lies outside the hub's component is compared with some of its own as long as that finds links. The
rest meets through an index of the first shingles in which each text differs from the hub. Where
many share one of them, the index goes on to their next ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cargolens.llm.common import small_batches, text_bytes
from cargolens.llm.components import components
from cargolens.session import stage

WORD_CACHE = 200_000  # hashes of words a task remembers
ROUNDS = 3            # of further comparisons around a hub, fewer if one finds no link
DEPTH = 3             # shingles that may make a key of the index around a hub
LONG = 8              # a list of the index has so many pairs for each entry that dealing it out takes
PARITY_BITS = 1024    # of the sketch that bounds in how many shingles two texts differ


@dataclass(frozen=True)
class Plan:
    """``bands`` x ``rows`` minima. At a similarity of 0.8 a pair shares no band with
    probability (1 - 0.8^rows)^bands, 3e-6 here; at 0.9 it is 1e-14. The estimate's standard
    error at 0.8 is 0.03 for 256 minima of 2 bits; ``slack`` is more than five of them."""

    shingle: int = 5
    percent: int = 80       # link if 100 * intersection >= percent * union
    bands: int = 42
    rows: int = 6
    bits: int = 2
    slack: float = 0.17
    seed: int = 20_011

    @property
    def minima(self) -> int:
        return 64 * -(-self.bands * self.rows // 64)

    @property
    def longs(self) -> int:
        return self.minima * self.bits // 64

    @property
    def cut(self) -> float:
        return self.percent / 100 - self.slack


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def _shingles(words: list[bytes], known: _Words, size: int) -> np.ndarray:
    """Sorted hashes (64 bits) of the distinct shingles."""
    if len(known) > WORD_CACHE:
        known.clear()
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    count = len(words) - size + 1
    mixed = np.full(count, np.uint64(size))
    for k in range(size):
        mixed = _mix(mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + count])
    return np.unique(mixed)


class _Sketcher:
    def __init__(self, plan: Plan) -> None:
        self.plan = plan
        random = np.random.default_rng(plan.seed)
        self.factors = random.integers(1 << 31, size=(plan.minima, 1), dtype=np.uint32) * 2 + 1
        self.offsets = random.integers(1 << 32, size=(plan.minima, 1), dtype=np.uint32)
        per = 64 // plan.bits
        self.shifts = (np.arange(per, dtype=np.uint64) * np.uint64(plan.bits))[None, :]

    def minima(self, shingles: np.ndarray, step: int = 512) -> np.ndarray:
        low = shingles.astype(np.uint32)
        out = np.full(self.plan.minima, np.uint32(0xFFFFFFFF))
        for start in range(0, len(low), step):
            values = self.factors * low[None, start:start + step]
            values += self.offsets
            np.minimum(out, values.min(axis=1), out=out)
        return out

    def buckets(self, minima: np.ndarray) -> np.ndarray:
        """One key for each band; the band's number is part of it."""
        rows = minima[:self.plan.bands * self.plan.rows].reshape(self.plan.bands, -1)
        key = np.arange(self.plan.bands, dtype=np.uint64)
        for k in range(self.plan.rows):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
        return key.view(np.int64)

    def packed(self, minima: np.ndarray) -> np.ndarray:
        # Low bits of a * x + b follow those of x, alike for every function; the mixed ones don't.
        mixed = _mix(minima.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        low = mixed & np.uint64((1 << self.plan.bits) - 1)
        low = low.reshape(self.plan.longs, -1) << self.shifts
        return np.bitwise_or.reduce(low, axis=1).view(np.int64)


def _parities(shingles: np.ndarray) -> np.ndarray:
    """A bit for each of ``PARITY_BITS`` hash values: is the number of shingles there odd? Bits in which
    two sketches differ have a shingle each that only one text has: never more than those."""
    counts = np.bincount((shingles >> np.uint64(32)) % np.uint64(PARITY_BITS), minlength=PARITY_BITS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: A-Z and ASCII white space only


def _node(words: list[bytes]) -> bytes:
    """Identity of a sequence of words, 128 bits."""
    return xxhash.xxh3_128_digest(b" ".join(words))


def _sketches(docs: DataFrame, plan: Plan) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher, known = _Sketcher(plan), _Words()
        for batch in batches:
            nodes, counts, buckets, signatures = [], [], [], []
            for text in batch.column(1).to_pylist():
                words = _words(text)
                if not words:
                    nodes.append(None)
                    counts.append(0)
                    buckets.append(None)
                    signatures.append(None)
                    continue
                shingles = _shingles(words, known, plan.shingle)
                minima = sketcher.minima(shingles)
                nodes.append(_node(words))
                counts.append(len(shingles))
                buckets.append(sketcher.buckets(minima))
                signatures.append(sketcher.packed(minima))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()),
                 pa.array(buckets, pa.list_(pa.int64())),
                 pa.array(signatures, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "node", "buckets", "signature"])

    source = docs.select(F.col("doc_id").cast("long"), text_bytes("text").alias("text"))
    return stage(source.mapInArrow(
        run, "doc_id long, n_shingles long, node binary, buckets array<long>, signature array<long>"),
        "minhash-sketches")


def _sets(docs: DataFrame, wanted: DataFrame, plan: Plan) -> DataFrame:
    """(node, shingles, parity) of the ``wanted`` (node, doc_id): their texts are read once more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in batches:
            lists = [_words(text) for text in batch.column(0).to_pylist()]
            lists = [words for words in lists if words]
            sets = [_shingles(words, known, plan.shingle) for words in lists]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(words) for words in lists], pa.binary()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.array([_parities(s) for s in sets], pa.list_(pa.int64()))],
                names=["node", "shingles", "parity"])

    ids = wanted.select(F.col("doc_id").alias("__id")).distinct()
    texts = (docs.select(F.col("doc_id").cast("long"), text_bytes("text").alias("text"))
             .join(ids, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi").select("text"))
    found = texts.mapInArrow(run, "node binary, shingles array<long>, parity array<long>")
    # Only a null or repeated doc_id can bring a text twice or one that isn't wanted.
    return stage(found.dropDuplicates(["node"]), "minhash-sets")


def unequal_low_bits(a: Column, b: Column, plan: Plan) -> Column:
    """In how many minima the packed low bits of two signatures differ."""
    ones = sum(1 << k for k in range(0, 64, plan.bits))
    mask = F.lit(ones - (1 << 64) if ones >> 63 else ones)
    total = F.lit(0)
    for k in range(plan.longs):
        x = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        folded = x
        for shift in range(1, plan.bits):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, shift))
        total = total + F.bit_count(folded.bitwiseAND(mask))
    return total


def estimated_similarity(unequal: Column, plan: Plan) -> Column:
    """Corrected for low bits that are equal by chance, (E - 2^-b) / (1 - 2^-b)."""
    return 1 - unequal / F.lit(plan.minima * (1 - 2.0 ** -plan.bits))


def _confirmed(pairs: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """Pairs (a, b) that reach the threshold on their full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    return stage(pairs.join(left, "a").join(right, "b")
                 .where(100 * both >= plan.percent * union).select("a", "b"), "minhash-links")


def _hub_pairs(rows: DataFrame) -> DataFrame:
    """Distinct (hub, node): each bucket's members and its hub, the one in most company."""
    weight = rows.groupBy("node").agg(F.sum("held").alias("weight"))
    hubs = (rows.join(weight, "node").groupBy("bucket")
            .agg(F.max(F.struct("weight", "node")).alias("hub"))
            .select("bucket", F.col("hub.node").alias("hub")))
    pairs = rows.join(stage(hubs, "minhash-hubs"), "bucket").where("node <> hub")
    return stage(pairs.select("hub", "node").distinct(), "minhash-hub-pairs")


def _ends(hub_pairs: DataFrame) -> DataFrame:
    return hub_pairs.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()


def _moved(hub_pairs: DataFrame, near: DataFrame) -> DataFrame:
    """(hub, to): hubs whose rows another hub takes over, of those they may be linked with (``near``) the one
    with most rows, if that has more than they have themselves. Whatever met around ``hub`` meets around ``to``."""
    rows = stage(hub_pairs.groupBy("hub").agg(F.count("*").alias("rows")), "minhash-hub-rows")
    both = near.select(F.col("a").alias("hub"), F.col("b").alias("to")).union(near.select("b", "a"))
    other = rows.select(F.col("hub").alias("to"), F.col("rows").alias("more"))
    return stage(both.join(rows, "hub").join(other, "to")
                 .where(F.struct("more", "to") > F.struct("rows", "hub"))
                 .groupBy("hub").agg(F.max(F.struct("more", "to")).alias("best"))
                 .select("hub", F.col("best.to").alias("to")), "minhash-moved")


def _taken_over(hub_pairs: DataFrame, moved: DataFrame) -> DataFrame:
    """Distinct (hub, node) with the rows of moved hubs, and these themselves, at those that took them over."""
    return (hub_pairs.join(moved, "hub", "left").select(F.coalesce("to", "hub").alias("hub"), "node")
            .union(moved.select("to", "hub")).where("hub <> node").distinct())


def _labelled(hub_pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """(hub, node, own, outside): with the node's component, and whether it isn't the hub's."""
    def label(column: str) -> DataFrame:
        return labels.select(F.col("node").alias(column), F.col("component").alias(f"own_{column}"))

    return (hub_pairs.join(label("node"), "node", "left").join(label("hub"), "hub", "left")
            .select("hub", "node", F.coalesce("own_node", "node").alias("own"),
                    F.coalesce("own_hub", "hub").alias("own_hub"))
            .select("hub", "node", "own", (F.col("own") != F.col("own_hub")).alias("outside")))


def _further_pairs(hub_pairs: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """(a, b): one of those outside the hub's component, another each ``turn``, and all in other components."""
    around = stage(_labelled(hub_pairs, labels), "minhash-open")
    picked = (around.where("outside").groupBy("hub")
              .agg(F.max(F.struct(F.xxhash64(F.lit(turn), "hub", "node"), "node", "own")).alias("best"))
              .select("hub", F.col("best.node").alias("pick"), F.col("best.own").alias("own_pick")))
    met = around.join(picked, "hub").where("own <> own_pick")
    return met.select(F.least("pick", "node").alias("a"), F.greatest("pick", "node").alias("b")).distinct()


def _remaining(hub_pairs: DataFrame, labels: DataFrame, sets: DataFrame, moved: DataFrame,
               plan: Plan) -> DataFrame:
    """Pairs around one hub, that which took it over, that lie in different components and may reach the threshold.

    A text around a hub is told by its difference: the shingles it adds to the hub's and those of the hub
    that it lacks. Two texts differ in as many shingles as their differences do, so they link if these share
    (e + e') / (2 * (100 + p)) of their entries, with e = (100 + p) * entries - (100 - p) * shingles.
    A text not linked with the hub of H shingles has an e above (100 - p) * H, every text one of
    -(100 - p) * H at least. That tells how many entries any link of a text must share, and in one order
    of the entries, the added ones first, how many of its first ones hold one of them (prefix filter).

    Texts that share an entry make a list, of those outside the hub's component for themselves, and with those
    inside. If edits repeat, lists are long. Links that must share two entries also share a second one, within a
    prefix longer by one, so a list whose pairs outnumber the entries that takes is dealt out by
    the second, and again, up to ``DEPTH`` of them; links that may share no more are looked for in it.
    """
    pairs = stage(_labelled(_taken_over(hub_pairs, moved), labels), "minhash-around")
    open_hubs = (pairs.groupBy("hub").agg(F.count_if("outside").alias("r"), F.count("*").alias("n"))
                 .where("r > 0 AND n > 1").select(
                     "hub", F.expr("filter(array(true, false), x -> IF(x, r > 1, r < n))").alias("sides")))
    both, apart = 100 + plan.percent, 100 - plan.percent
    edge = apart * F.size("h")
    least = F.when(F.expr("outside AND NOT beyond"), -edge).otherwise(edge + 1)   # of the other's e
    needed = F.greatest(F.lit(1), F.ceil((F.col("e") + least) / F.lit(2 * both))).cast("int")
    around = (pairs.join(open_hubs, "hub")
              .join(sets.select("node", F.col("shingles").alias("s")), "node")
              .join(sets.select(F.col("node").alias("hub"), F.col("shingles").alias("h")), "hub")
              .withColumn("ids", F.concat(F.array_sort(F.array_except("s", "h")), F.array_sort(F.array_except("h", "s"))))
              .withColumns({"n": F.size("s"), "entries": F.size("ids"), "beyond": F.explode("sides")})
              .where("outside OR NOT beyond")
              .withColumn("e", both * F.col("entries") - apart * F.col("n"))
              .withColumn("needed", needed)
              .withColumn("first", F.col("entries") - F.col("needed") + 1).where("first > 0"))
    row = ["hub", "node", "own", "outside", "beyond", "n", "entries", "e", "needed", "first"]
    around = stage(around.select(*row, F.slice("ids", F.lit(1), F.col("first") + DEPTH - 1).alias("ids")),
                   "minhash-differences")
    # Those that do occur narrow it: the other's e, and what the other can share at most.
    reach = both * F.col("entries") + apart * F.col("n")
    bounds = stage(around.groupBy("hub").agg(
        F.min(F.when(F.col("outside"), F.col("e"))).alias("low_beyond"),
        F.min(F.when(~F.col("outside"), F.col("e"))).alias("low_within"),
        F.max(F.when(F.col("outside"), reach)).alias("reach_beyond"),
        F.max(F.when(~F.col("outside"), reach)).alias("reach_within")), "minhash-bounds")
    within = F.expr("outside AND NOT beyond")
    low = F.when(within, F.col("low_within")).otherwise(F.col("low_beyond"))
    most = F.when(within, F.col("reach_within")).otherwise(F.col("reach_beyond"))
    around = stage(around.join(bounds, "hub").where(F.col("e") <= most).withColumn("needed", F.greatest(
                       F.col("needed"), F.ceil((F.col("e") + low) / F.lit(2 * both)).cast("int")))
                   .withColumn("first", F.col("entries") - F.col("needed") + 1).where("first > 0")
                   .select(*row, "ids"), "minhash-differences")
    lists = around.select(*row, F.posexplode(F.slice("ids", F.lit(1), F.col("first"))).alias("at", "key"))
    parity, met = sets.select("node", "parity"), []
    for depth in range(1, DEPTH + 1):
        lists = stage(lists, "minhash-prefixes")
        meet = F.when(F.col("beyond"), F.col("r") * (F.col("r") - 1) / 2).otherwise(F.col("r") * (F.col("m") - F.col("r")))
        long = F.lit(depth < DEPTH) & (meet > LONG * F.col("further"))
        kept = (lists.groupBy("hub", "beyond", "key").agg(
            F.count("*").alias("m"), F.count_if("outside").alias("r"), F.min("own").alias("low"), F.max("own").alias("high"),
            F.sum(F.col("first") + depth - 1 - F.col("at")).alias("further"))
            .where("r > 0 AND low <> high AND (beyond OR r < m)").select("hub", "beyond", "key", long.alias("long")))
        lists = stage(lists.join(kept, ["hub", "beyond", "key"]), "minhash-lists")
        asking = lists.where(F.expr("NOT long") | (F.col("needed") <= depth))
        met.append(stage(_met(asking.join(parity, "node"), depth, plan), "minhash-met"))
        lists = lists.where("long")
        if depth == DEPTH or lists.isEmpty():
            break
        lists = (lists.select(*row, F.col("at").alias("before"), F.col("key").alias("path"))
                 .join(around.select("hub", "node", "beyond", "ids"), ["hub", "node", "beyond"])
                 .select(*row, "before", "path", F.posexplode(F.slice(
                     "ids", F.col("before") + 2, F.col("first") + depth - 1 - F.col("before"))).alias("at", "key"))
                 .select(*row, (F.col("before") + 1 + F.col("at")).alias("at"),
                         F.xxhash64("path", "key").alias("key")))
    return reduce(DataFrame.union, met).distinct()


def _met(lists: DataFrame, depth: int, plan: Plan) -> DataFrame:
    """Pairs (a, b) of members of one list, the first of them outside, that the place of their ``depth``-th
    shared entry and their parity sketches don't rule out; of a long list only those that need share no more."""
    both, apart = 100 + plan.percent, 100 - plan.percent
    other = lists.where("beyond OR NOT outside").select("hub", "beyond", "key", *[
        F.col(c).alias(f"{c}_b") for c in ("node", "own", "n", "entries", "e", "at", "parity")])
    left = F.least(F.col("entries") - F.col("at"), F.col("entries_b") - F.col("at_b")) + depth - 1
    shared = F.col("e") + F.col("e_b")
    differ = F.lit(0)
    for k in range(PARITY_BITS // 64):
        differ = differ + F.bit_count(F.get("parity", F.lit(k)).bitwiseXOR(F.get("parity_b", F.lit(k))))
    return (lists.where("outside").join(other, ["hub", "beyond", "key"])
            .where(F.expr("own <> own_b AND (NOT beyond OR node < node_b)")
                   & (2 * both * left >= shared) & (F.expr("NOT long") | (shared <= 2 * both * depth))
                   & (both * differ <= apart * (F.col("n") + F.col("n_b"))))
            .select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b"))
            .distinct())


def _possible(pairs: DataFrame, signatures: DataFrame, plan: Plan) -> DataFrame:
    """Pairs (a, b) whose estimate doesn't rule out the threshold."""
    unequal = unequal_low_bits(F.col("x"), F.col("y"), plan)
    return (pairs.join(signatures.select(F.col("node").alias("a"), F.col("signature").alias("x")), "a")
            .join(signatures.select(F.col("node").alias("b"), F.col("signature").alias("y")), "b")
            .where(estimated_similarity(unequal, plan) >= plan.cut).select("a", "b"))


def _grouped(docs: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """Stored sketches of all rows, and (node, component, component_id) of the classes of words."""
    small_batches(docs.sparkSession)
    sketches = _sketches(docs, plan)
    classes = stage(
        sketches.where(F.col("node").isNotNull()).groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("buckets").alias("buckets"),
            F.first("signature").alias("signature")), "minhash-classes")
    signatures = classes.select("node", "signature")

    spread = classes.select(F.explode("buckets").alias("bucket"), "node")
    held = spread.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1")
    rows = stage(spread.join(held, "bucket"), "minhash-buckets")
    wanted = classes.join(rows.select("node").distinct(), "node").select("node", "doc_id")
    sets = _sets(docs, wanted, plan)

    hub_pairs = _hub_pairs(rows)
    pairs = _ends(hub_pairs)
    near = stage(_possible(pairs, signatures, plan), "minhash-near")
    moved = _moved(hub_pairs, near)
    new = _ends(_taken_over(hub_pairs, moved)).join(pairs, ["a", "b"], "left_anti")
    links = _confirmed(near.union(_possible(new, signatures, plan)), sets, plan)
    labels = stage(components(links), "minhash-labels")
    for turn in range(ROUNDS):
        more = _confirmed(_possible(_further_pairs(hub_pairs, labels, turn), signatures, plan), sets, plan)
        if more.isEmpty():
            break
        links = links.union(more)
        labels = stage(components(links), "minhash-labels")
    pairs = _remaining(hub_pairs, labels, sets, moved, plan)
    more = _confirmed(_possible(pairs, signatures, plan), sets, plan)
    labels = stage(components(links.union(more)), "minhash-labels")

    labelled = stage(classes.select("node", "doc_id").join(labels, "node", "left").select(
        "node", "doc_id", F.coalesce("component", "node").alias("component")), "minhash-classes")
    low = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return sketches, stage(labelled.join(low, "component").select("node", "component", "component_id"),
                           "minhash-found")


def _judged(sketches: DataFrame, found: DataFrame) -> DataFrame:
    return (sketches.select("doc_id", "n_shingles", "node").join(found, "node", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("node").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def near_duplicates(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id among all
    it is linked with, directly or not), kept (it is that document).

    Words are split at ASCII white space, A-Z lower-cased; fewer words than a shingle are one
    shingle. A text without words, or null, has none and is linked with nothing: its
    component_id is its own doc_id. Texts of equal words are one class and are compared once. A
    null doc_id is the smallest of its component only if there is no other; equal rows are
    each kept or each not. Other columns are not read.
    """
    return _judged(*_grouped(docs, plan))


def _one_row_each(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Of stored ``rows`` with ``__row``, whose ids aren't those of one row: the first row of each
    component that has the component's id, and every row without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = map(_words, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([_node(words) if words else None for words in lists], pa.binary())],
                names=["__row", "doc_id", "node"])

    nodes = stage(rows.select("__row", F.col("doc_id").cast("long"), text_bytes("text").alias("text"))
                  .mapInArrow(run, "__row long, doc_id long, node binary"), "minhash-shared-nodes")
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = nodes.join(found, "node").where(own).groupBy("component").agg(F.min("__row").alias("__row"))
    picked = first.select("__row").union(nodes.where("node IS NULL").select("__row"))
    return rows.join(picked, "__row", "left_semi").drop("__row")


def near_dedup(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are: exactly one row of each group, and
    every row without words. A row is found by its doc_id; rows whose id is null or comes again
    are stored with a number and chosen by that."""
    sketches, found = _grouped(docs, plan)
    shared = stage(sketches.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
                   .select(F.col("doc_id").alias("__shared")), "minhash-shared-ids")
    kept = _judged(sketches, found).where("kept").select(F.col("doc_id").alias("__id"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
    if shared.isEmpty():
        return docs.join(kept, same, "left_semi")
    ours = F.col("doc_id").cast("long").eqNullSafe(F.col("__shared"))
    rows = stage(docs.join(shared, ours, "left_semi")
                 .withColumn("__row", F.monotonically_increasing_id()), "minhash-shared-rows")
    once = kept.join(shared, F.col("__id").eqNullSafe(F.col("__shared")), "left_anti")
    return docs.join(once, same, "left_semi").unionByName(_one_row_each(rows, found))
