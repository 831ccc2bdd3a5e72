import math
import random
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from cargolens.llm.importance import Resampling, gumbel, resample

from .helpers import DOCS, corpus

LABELS = "doc_id LONG, quality INT, toxic INT, extra STRING"


def buckets(text, bits):
    words = (text or "").encode().lower().split()
    one = [xxhash.xxh3_64_intdigest(w) for w in words]
    out, mask = [h >> (64 - bits) for h in one], (1 << 64) - 1
    for a, b in zip(one, one[1:]):
        x = (a * 0x9E3779B97F4A7C15 + b) & mask
        out.append((((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9) & mask) >> (64 - bits))
    return out


def brute(texts, good, bits):
    raw, target, size = Counter(), Counter(), 1 << bits
    for i, text in enumerate(texts):
        raw.update(buckets(text, bits))
        if i in good:
            target.update(buckets(text, bits))
    n, m = sum(raw.values()) + size, sum(target.values()) + size
    return [sum(math.log((target[b] + 1) / m) - math.log((raw[b] + 1) / n) for b in buckets(t, bits))
            for t in texts]


def test_weights_equal_brute_force_and_k_are_drawn(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "One", "a" * 200_000] + [
        " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 40))) for _ in range(200)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 0, None) for i in range(0, 150)]
                                   + [(None, 1, 0, None), (7, None, None, None)], LABELS)
    plan = Resampling(bits=6)
    rows = resample(corpus(spark, texts).repartition(4), labels, plan).collect()
    want = brute(texts, {i for i in range(150) if i % 3 == 0}, 6)
    got = {r["doc_id"]: r for r in rows}
    assert np.allclose([got[i]["log_weight"] for i in range(len(texts))], want)
    assert all(got[i]["n_grams"] == len(buckets(t, 6)) for i, t in enumerate(texts))
    kept = [r["gumbel_key"] for r in rows if r["kept"]]
    assert len(kept) == round(51 / 152 * len(texts))
    assert min(kept) >= max(r["gumbel_key"] for r in rows if not r["kept"])


def test_draws_follow_the_weights():
    """Gumbel top-1 of log weights draws in proportion to the weights."""
    weights = np.array([1.0, 2.0, 5.0])
    hashes = np.array([[xxhash.xxh3_64_intdigest(f"{t} {k}".encode()) for k in range(3)]
                       for t in range(20_000)], np.uint64).view(np.int64)
    first = (np.log(weights) + gumbel(hashes.reshape(-1)).reshape(-1, 3)).argmax(axis=1)
    assert np.abs(np.bincount(first) / len(first) - weights / 8).max() < 0.015


def test_held_out_labels_are_told_apart(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = resample(docs, labels.where("doc_id % 2 = 0")).join(
        labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = np.array([r["log_weight"] for r in rows if r["quality"] == 1])
    bad = np.array([r["log_weight"] for r in rows if r["quality"] == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert np.mean([r["kept"] for r in rows if r["quality"] == 1]) > 0.97
    assert np.mean([r["kept"] for r in rows if r["quality"] == 0]) < 0.2


def test_no_rows_no_labels_and_repeated_rows(spark):
    none = spark.createDataFrame([], LABELS)
    assert resample(spark.createDataFrame([], DOCS), none).count() == 0
    docs = spark.createDataFrame([(1, "a b", None, None, 1, None)] * 4 + [(None, None, None, None, 0, None)], DOCS)
    assert resample(docs, none).where("kept").count() == 0
    assert resample(docs, none, Resampling(fraction=0.4)).where(F.col("kept")).count() == 2
