import bisect
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from cargolens.llm.bfd_sharding import (GapTree, best_fit_decreasing, even_bins, fewest_capacity,
                                        shard_documents)

from .helpers import DOCS, corpus


def depth(node):
    return 0 if node is None else 1 + max(depth(node[2]), depth(node[3]))


def test_tree_finds_the_tightest_gap_and_stays_balanced():
    rng, tree, plain = random.Random(4), GapTree(), []
    for k in range(20_000):
        if rng.random() < 0.6 or not plain:
            key = (k if k < 5000 else rng.randrange(500), k)
            tree.add(*key)
            bisect.insort(plain, key)
        else:
            size = rng.randrange(6000)
            at = bisect.bisect_left(plain, (size, -1))
            assert tree.take_tightest(size) == (plain.pop(at) if at < len(plain) else None)
    assert depth(tree.root) < 60


def plain_bfd(sizes, capacity):
    gaps, out = [], [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        fits = [(g, b) for b, g in enumerate(gaps) if g >= sizes[k]]
        if fits:
            bin_ = min(fits)[1]
        else:
            bin_ = len(gaps)
            gaps.append(capacity)
        gaps[bin_] = max(0, gaps[bin_] - sizes[k])
        out[k] = bin_
    return out


def test_bins_equal_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(20):
        sizes = rng.integers(1, 120, 150)
        assert best_fit_decreasing(sizes, 100).tolist() == plain_bfd(sizes.tolist(), 100)
    bins = fewest_capacity(sizes, 7)
    loads = np.bincount(bins, sizes)
    assert len(loads) <= 7 and loads.max() <= 1.02 * sizes.sum() / 7


def check(spark, texts, shards, part_groups, spread):
    rows = shard_documents(corpus(spark, texts).repartition(4), shards, part_groups).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    shard_of, loads = {}, [0] * shards
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert r["size"] == len(text.encode()) + 1 and r["text_crc32"] == zlib.crc32(text.encode())
        assert shard_of.setdefault(text, r["shard"]) == r["shard"]
        loads[r["shard"]] += r["size"]
    for shard in range(shards):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert max(loads) - min(loads) <= spread * sum(loads) / shards


def test_sizes_are_near_equal_and_groups_stay_whole(spark):
    rng = random.Random(3)
    texts = [None, "", "é𝄞"] + ["a" * rng.choice([1, 3, 500, rng.randint(1, 5000)]) + str(rng.randrange(900))
                                for _ in range(3000)]
    check(spark, texts + ["hot text"] * 900, 8, 400, 0.01)
    check(spark, ["big" * 5000] * 50 + texts[:200], 3, 100, 3)


def test_few_rows_repeated_rows_and_none(spark):
    assert shard_documents(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, "t", None, None, 1, "x")] * 4 + [(2, None, None, None, 1, None)]
    got = shard_documents(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == 5 and sorted(r["slot"] for r in got) == [0, 0, 1, 2, 3]


def test_other_shards_stay_near_equal_beside_large_groups(spark):
    for share in (0.15, 0.2, 0.33, 0.99):
        hot = int(4_000_000 * share / (1 - share))
        loads = np.bincount(even_bins(np.array([1000] * 2000 + [hot] + [1000] * 2000), 8),
                            [1000] * 2000 + [hot] + [1000] * 2000, 8)
        assert loads.max() == hot and np.ptp(np.sort(loads)[:7]) <= 0.01 * 4_000_000 / 7
    for sizes, want in (([10] * 9, [10] * 7 + [20]), ([10] * 10, [10] * 6 + [20] * 2), ([5, 5], [0] * 6 + [5, 5]),
                        ([900, 300, 1], [0] * 5 + [1, 300, 900])):
        assert sorted(np.bincount(even_bins(np.array(sizes), 8), sizes, 8)) == want
    rng = random.Random(8)
    texts = ["a" * rng.randint(1, 900) + str(k) for k in range(4000)]
    for copies in (3000, 200_000):     # a third of the bytes, nearly all
        hot = "hot text " * 40
        rows = [(k, t, None, None, 1, None) for k, t in enumerate(texts)]
        docs = spark.createDataFrame(rows, DOCS).union(spark.range(copies).selectExpr(
            "id + 10000", f"'{hot}'", "null", "null", "1", "null"))
        loads = sorted(r["n"] for r in shard_documents(docs, 8, 500).groupBy("shard").agg(
            F.sum("size").alias("n")).collect())
        assert len(loads) == 8 and loads[-1] == copies * (len(hot) + 1)
        assert loads[6] - loads[0] <= 0.01 * sum(loads[:7]) / 7
