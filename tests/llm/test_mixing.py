import random
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from cargolens.llm.mixing import (Mix, choose_blocks, in_order, mix, split, taken_words, targets)

from .helpers import DOCS, corpus


def brute_targets(sizes, weights, most):
    """Bisect the common level of the sources below their cap."""
    low, high = 0.0, 10.0 * sum(sizes) + 1
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(level * w, most * s) for w, s in zip(weights, sizes)) < sum(sizes):
            low = level
        else:
            high = level
    return [min(high * w, most * s) for w, s in zip(weights, sizes)]


def test_targets_reshare_what_is_cut_off():
    rng = random.Random(4)
    for _ in range(50):
        sizes = [rng.choice([0, 1, rng.randint(1, 10 ** rng.randint(1, 6))]) for _ in range(9)]
        weights = [1 + k % 3 for k in range(9)]
        got = targets(sizes, weights, 3)
        assert sum(got) == sum(sizes)
        assert np.allclose([float(g) for g in got], brute_targets(sizes, weights, 3), rtol=1e-6)


def test_blocks_come_near_the_target_and_the_tree_keeps_quotas():
    words = np.array([7, 1, 30, 12, 9, 4])
    for target in (0, 5, 63, 64, 100, 189):
        tickets = choose_blocks(words, np.arange(6), Fraction(target), 3)
        assert len(set(tickets)) == len(tickets)
        assert abs(sum(words[b] for b, _ in tickets) - target) <= max(1, target // 1000)
    quotas = np.array([1000, 0, 17, 3])
    leaves = split(quotas, 7, 5)
    assert (leaves.sum(axis=0) == quotas).all() and (leaves >= 0).all()
    assert np.ptp(leaves.sum(axis=1)) <= 7
    assert (split(quotas, 7, 5) == leaves).all()


def test_rows_meet_targets_and_reruns_agree(spark):
    rng = random.Random(8)
    texts = [None, "", " "] + ["w " * rng.randint(1, 60) for _ in range(3000)]
    docs = corpus(spark, texts, source=lambda i: [None, "a", "B", "é", "b"][
        0 if i % 2 else min(4, 1 + i % 40 // 2)]).repartition(4)
    got = sorted(tuple(r) for r in taken_words(docs).collect())
    assert got == sorted(tuple(r) for r in taken_words(docs.repartition(7)).collect())
    sources = {r["doc_id"]: r["source"] for r in docs.collect()}
    size, taken, goal = {}, {}, {}
    for doc_id, n, source_size, target, words, shards in got:
        s = sources[doc_id]
        assert n == len((texts[doc_id] or "").split()) and words <= 3 * n
        size[s], taken[s] = size.get(s, 0) + n, taken.get(s, 0) + words
        goal[s] = (source_size, target)
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    want = targets([size[s] for s in order], [1 + k % 3 for k in range(len(order))], 3)
    for s, w in zip(order, want):
        assert goal[s] == (size[s], float(w))
        assert abs(taken[s] - float(w)) <= 30


def test_mix_returns_rows_by_shard(spark):
    docs = corpus(spark, [f"word {i} of it" for i in range(600)])
    mixed = mix(docs, Mix(shards=4))
    rows = mixed.select("doc_id", "slot", "__shard", "__place").collect()
    assert {r["__shard"] for r in rows} == {0, 1, 2, 3} and {r["slot"] for r in rows} == {"x"}
    counts = {}
    for r in rows:
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    words = {r["doc_id"]: r["taken"] for r in taken_words(docs, Mix(shards=4)).collect()}
    assert {k: 4 * n for k, n in counts.items()} == {k: v for k, v in words.items() if v}
    ordered = in_order(mixed)
    assert ordered.columns == docs.columns and ordered.count() == len(rows)


def test_empty_table_and_no_words(spark):
    assert taken_words(spark.createDataFrame([], DOCS)).count() == 0
    assert mix(spark.createDataFrame([], DOCS)).count() == 0
    rows = taken_words(corpus(spark, [None, "", " "])).collect()
    assert {(r["size"], r["target"], r["taken"]) for r in rows} == {(0, 0.0, 0)}
