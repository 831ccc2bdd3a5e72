"""Importance resampling of raw text towards a target.

Words and word pairs are hashed into buckets. Two generative models, bags of hashed n-grams with
add-one smoothing, are counted: one over the target texts and one over all. A document's weight
is the log ratio of its probabilities under the two. Adding Gumbel noise to the log weights and
taking the k greatest draws k documents without replacement, with chances by weight.

The raw model counts all documents. The target's texts are labelled rows, at most
``TARGET_ROWS`` of them, chosen by hash; the models are two arrays of ``2 ** bits`` counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from cargolens.llm.common import small_batches, text_bytes
from cargolens.operators.row_numbers import number_rows
from cargolens.session import stage

TARGET_ROWS = 50_000
WORD_CACHE = 200_000


@dataclass(frozen=True)
class Resampling:
    bits: int = 16              # buckets of n-grams, as a power of 2
    fraction: float | None = None   # of the documents to draw; None: the target's share of labels
    seed: int = 29


class _Grams:
    """Buckets of a text's words and word pairs, A-Z lower-cased."""

    def __init__(self, bits: int) -> None:
        self.shift = np.uint64(64 - bits)
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        if len(self.known) > WORD_CACHE:
            self.known.clear()
        words, known = text.lower().split(), self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        one = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]
        two = (two ^ (two >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (np.concatenate([one, two]) >> self.shift).astype(np.int64)


def target_ids(labels: DataFrame, plan: Resampling) -> tuple[set[int], float]:
    """At most ``TARGET_ROWS`` ids of good labels, and the share of good labels among all."""
    good = F.coalesce(F.col("quality") == 1, F.lit(False))
    share = labels.agg(F.avg(good.cast("double"))).first()[0] or 0.0
    rows = (labels.where(good & F.col("doc_id").isNotNull()).select("doc_id").distinct()
            .orderBy(F.xxhash64("doc_id", F.lit(plan.seed)), "doc_id").limit(TARGET_ROWS).collect())
    return {r["doc_id"] for r in rows}, float(share)


def log_ratios(docs: DataFrame, targets: set[int], plan: Resampling) -> np.ndarray:
    """Log of target over raw probability for each bucket.

    Each task adds up its documents and hands over one row for each bucket it has met.
    """
    size = 1 << plan.bits
    chosen = docs.sparkSession.sparkContext.broadcast(targets)  # at most TARGET_ROWS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, raw, good = _Grams(plan.bits), np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = grams(text)
                np.add.at(raw, found, 1)
                if doc_id in chosen.value:
                    np.add.at(good, found, 1)
        met = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(raw[met]), pa.array(good[met])],
                                         names=["bucket", "raw", "good"])

    counted = docs.mapInArrow(count, "bucket long, raw long, good long")
    rows = counted.groupBy("bucket").agg(F.sum("raw"), F.sum("good")).collect()  # 2 ** bits rows
    raw, good = np.zeros(size), np.zeros(size)
    for bucket, n, m in rows:
        raw[bucket], good[bucket] = n, m
    return np.log((good + 1) / (good.sum() + size)) - np.log((raw + 1) / (raw.sum() + size))


def gumbel(doc_hashes: np.ndarray) -> np.ndarray:
    """Gumbel noise from hashes of 64 bits."""
    uniform = ((doc_hashes.view(np.uint64) >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
    return -np.log(-np.log(uniform))


def resample(docs: DataFrame, labels: DataFrame, plan: Resampling = Resampling()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_grams, log_weight, gumbel_key, kept (drawn).

    Null and empty texts have no n-grams and weight 0, the log of an even chance. A null doc_id
    never is a target; repeated rows have equal keys and are ranked in any order. Without good
    labels the target model is uniform, and nothing is drawn unless ``fraction`` is given.
    """
    spark: SparkSession = small_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long"), text_bytes("text").alias("text"))
    targets, share = target_ids(labels, plan)
    ratios = spark.sparkContext.broadcast(log_ratios(source, targets, plan))  # 2 ** bits numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = _Grams(plan.bits)
        for batch in batches:
            found = [grams(text) for text in batch.column(1).to_pylist()]
            weights = np.array([ratios.value[f].sum() for f in found])
            noise = gumbel(batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(f) for f in found], pa.int64()),
                 pa.array(weights, pa.float64()), pa.array(weights + noise, pa.float64())],
                names=["doc_id", "n_grams", "log_weight", "gumbel_key"])

    scored = stage(source.withColumn("h", F.xxhash64("doc_id", F.lit(plan.seed))).mapInArrow(
        score, "doc_id long, n_grams long, log_weight double, gumbel_key double"), "importance-scores")
    wanted = round((share if plan.fraction is None else plan.fraction) * scored.count())
    ranked = number_rows(scored, ["gumbel_key", "doc_id"], "rank", descending=True)
    return ranked.withColumn("kept", F.col("rank") < wanted).drop("rank")
