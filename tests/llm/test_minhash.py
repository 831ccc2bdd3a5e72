import random

import pytest
from pyspark.sql import functions as F

from cargolens.llm import minhash
from cargolens.llm.components import components
from cargolens.llm.minhash import Plan, estimated_similarity, near_dedup, near_duplicates, unequal_low_bits

from .helpers import DOCS, corpus

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = (text or "").translate(LOWER).encode().split()
    if not words:
        return set()
    size = min(size, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def expected(texts, plan):
    sets = [shingles(t, plan.shingle) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= plan.percent * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(i, len(s), find(i), find(i) == i) for i, s in enumerate(sets)]


def changed(words, share, rng):
    return [rng.choice("abcdefghij") * 5 if rng.random() < share else w for w in words]


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_brute_force(spark, size):
    rng = random.Random(size)
    texts = [None, "", " \n", "one", "One", "one two", "TWO words", "two Words", "É x", "é x"]
    for _ in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([8, 60, 200]))]
        texts += [" ".join(changed(base, rng.choice([0, .01, .03, .05]), rng)) for _ in range(12)]
    chain = [f"c{k}" for k in range(120)]           # each is linked to the next, not to the last
    for k in range(25):
        chain = chain[2:] + [f"n{k}", f"m{k}"]
        texts.append(" ".join(chain))
    for _ in range(3):                              # copies just below the threshold of their origin
        base = [f"o{rng.randrange(400)}" for _ in range(150)]
        texts += [" ".join(changed(base, .055 if size == 2 else .022, rng)) for _ in range(60)]
    texts += [" ".join(f"u{rng.randrange(900)}" for _ in range(40)) for _ in range(60)]
    texts.append(" ".join(f"l{k % 4001}" for k in range(60_000)))
    plan = Plan(shingle=size)
    got = near_duplicates(corpus(spark, texts).repartition(4), plan).collect()
    assert sorted(tuple(r) for r in got) == expected(texts, plan)


def test_dedup_keeps_columns_and_one_of_each_group(spark):
    docs = corpus(spark, ["a b c d e f", "A b c d e f", None, "other words here"], first=5)
    kept = near_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [5, 7, 8]
    assert near_dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c", None, None, 0, None), (None, "x y", None, None, 0, None),
            (3, "a b c", None, None, 0, None), (3, "a b c", None, None, 0, None)]
    got = near_duplicates(spark.createDataFrame(rows, DOCS), Plan(shingle=2))
    assert sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in got.collect()), key=repr) == [
        (3, 3, True), (3, 3, True), (None, 3, False), (None, None, True)]


def test_dedup_keeps_one_row_of_each_group_of_repeated_ids(spark):
    near = " ".join(f"w{k}" for k in range(60))
    texts = [(None, near), (None, near + " more"), (None, "all other words of its own"), (None, None), (None, ""),
             (7, "one text twice in full"), (7, "one text twice in full"), (7, "a second text under the id"),
             (8, "a second text under the id"), (9, "alone with its id"), (9, None), (10, "the last one is unique")]
    docs = spark.createDataFrame([(d, t, None, None, 0, str(k)) for k, (d, t) in enumerate(texts)], DOCS)
    kept = near_dedup(docs.repartition(3))
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    want = [(None, "all other words of its own"), (None, None), (None, ""), (7, "one text twice in full"),
            (7, "a second text under the id"), (9, "alone with its id"), (9, None), (10, "the last one is unique")]
    left = [row for row in got if row[1] is None or not row[1].startswith(near)]
    assert left == sorted(want, key=repr) and len(got) == len(want) + 1


def test_estimate_follows_the_true_similarity(spark):
    from cargolens.llm.minhash import _Sketcher
    import numpy as np
    plan, rng = Plan(), np.random.default_rng(3)
    sketcher = _Sketcher(plan)
    errors = []
    for similarity in (0.3, 0.5, 0.8, 0.95):
        for _ in range(20):
            union = rng.integers(1 << 62, size=1000).astype(np.uint64)
            shared = int(1000 * similarity)
            half = shared + (1000 - shared) // 2
            a, b = union[:half], np.concatenate([union[:shared], union[half:]])
            x, y = (sketcher.packed(sketcher.minima(s)).tolist() for s in (a, b))
            errors.append((similarity, x, y))
    rows = spark.createDataFrame(errors, "s DOUBLE, x ARRAY<LONG>, y ARRAY<LONG>")
    got = rows.select("s", estimated_similarity(
        unequal_low_bits(F.col("x"), F.col("y"), plan), plan).alias("e")).toPandas()
    assert ((got["e"] - got["s"]).abs() < 0.17).all()
    assert ((got.groupby("s")["e"].mean() - got.groupby("s")["e"].mean().index).abs() < 0.03).all()


def test_estimate_keeps_short_texts_at_the_threshold():
    """4 of 5 shingles shared: the estimate must not lose more links than the bands do."""
    from cargolens.llm.minhash import _Sketcher
    import numpy as np
    plan, rng = Plan(), np.random.default_rng(9)
    sketcher, most = _Sketcher(plan), 0
    for _ in range(20_000):
        union = rng.integers(1 << 62, size=5).astype(np.uint64)
        x, y = (sketcher.packed(sketcher.minima(s)).view(np.uint64) for s in (union, union[:4]))
        differ = x ^ y
        differ = (differ | differ >> np.uint64(1)) & np.uint64(0x5555555555555555)
        most = max(most, int(np.bitwise_count(differ).sum()))
    assert 1 - most / (plan.minima * 0.75) >= plan.cut


def test_components_of_paths_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    links += [(2000, 2001), (2001, 2002), (2002, 2000), (5, 5), (None, 4)]
    got = {r["node"]: r["component"] for r in
           components(spark.createDataFrame(links, "a LONG, b LONG")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1300)},
                   **{i: 2000 for i in range(2000, 2003)}}


def variants(n, seed):
    """Texts with up to six of thirty words changed: most aren't linked with their origin."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(100)}" for _ in range(30)]
    out = set()
    while len(out) < n:
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(30)] = f"w{rng.randrange(100)}"
        out.add(" ".join(words))
    return sorted(out)


def test_candidates_around_a_hub_stay_few(spark, monkeypatch):
    """Fewer candidates than rows around hubs, though most texts lie outside their hub's component."""
    remaining = minhash._remaining
    for n in (150, 300, 600):
        seen = []

        def counted(*arguments):
            pairs = remaining(*arguments)
            seen.append((arguments[0].count(), pairs.count()))
            return pairs
        monkeypatch.setattr(minhash, "_remaining", counted)
        texts = variants(n, n)
        plan = Plan(shingle=2)
        got = near_duplicates(corpus(spark, texts), plan).orderBy("doc_id").collect()
        assert [tuple(r) for r in got] == expected(texts, plan)
        ((around, pairs),) = seen
        assert around >= n and pairs <= around


def repeated_edits(n, seed):
    """Copies whose edits add the same shingles: every place has one other word, or is left out."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(3000)}" for _ in range(150)]
    other = [f"w{rng.randrange(3000)}" for _ in base]
    out = set()
    while len(out) < n:
        share, cut = rng.uniform(0, .11), len(out) % 2
        words = [y if rng.random() < share else x for x, y in zip(base, other)]
        out.add(" ".join(w for w, y in zip(words, other) if not (cut and w == y)))
    return sorted(out)


def test_repeated_edits_do_not_meet_pair_by_pair(spark, monkeypatch):
    """Candidates around hubs stay fewer than texts when copies share their edits, and no link is lost."""
    remaining, plan, seen = minhash._remaining, Plan(shingle=2), []

    def counted(*arguments):
        pairs = remaining(*arguments)
        seen.append(pairs.count())
        return pairs
    monkeypatch.setattr(minhash, "_remaining", counted)
    for n in (200, 400):
        texts = repeated_edits(n, n)
        got = near_duplicates(corpus(spark, texts), plan).orderBy("doc_id").collect()
        assert [tuple(r) for r in got] == expected(texts, plan)
        assert seen.pop() <= n


def test_long_lists_are_dealt_out_by_further_shingles(spark, monkeypatch):
    """With every list dealt out as far as it goes, the components are still those of brute force."""
    monkeypatch.setattr(minhash, "LONG", 0)
    plan = Plan(shingle=2)
    texts = repeated_edits(120, 7) + variants(150, 8)
    got = near_duplicates(corpus(spark, texts), plan).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected(texts, plan)


def test_parity_sketches_never_exceed_the_difference():
    import numpy as np
    rng = np.random.default_rng(5)
    for _ in range(200):
        union = rng.integers(1 << 62, size=int(rng.integers(1, 3000))).astype(np.uint64)
        mine, yours = (union[rng.random(len(union)) < .7] for _ in "ab")
        x, y = (minhash._parities(s).view(np.uint64) for s in (mine, yours))
        assert len(x) == 16 and int(np.bitwise_count(x ^ y).sum()) <= len(np.setxor1d(mine, yours))
