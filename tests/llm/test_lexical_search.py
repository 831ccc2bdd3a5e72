import math
import random
import re

import pytest

from cargolens.llm.lexical_search import Plan, _kth_floor, item_terms, search, segments
from tests.llm.helpers import corpus

RNG = random.Random(11)
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}
ITEMS = "item_id LONG, text STRING, rank STRING"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top=50):
    """The contract, said plainly: every document for every item."""
    held = [(doc_id, terms(text)) for doc_id, text in docs]
    n_docs, n_words = sum(1 for _, t in held if t), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = {}
    for item, wanted in asked.items():
        scores = []
        for doc_id, t in held:
            if not t:
                continue
            m = 50 + 50 * len(t) * n_docs // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[q] + 1)))
                        * (1_000_000_000 * t.count(q) // (1000 * t.count(q) + 20 * m))
                        for q in wanted if q in t)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out[item] = [(d[3], -d[0]) for d in sorted(scores)[:top]]
    return {i: x for i, x in out.items() if x}


def got(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    for item, rows in out.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
    return {i: [r[1:] for r in rows] for i, rows in out.items()}


def texts(n, rng):
    common, rare = ["the", "Of", "and", "is", "été"], [f"r{i}" for i in range(150)]
    out = [None, "", "--- ...", "The", "the the the", "x_y-z THE été ÉTÉ", "the " * 50_000]
    while len(out) < n:
        words = rng.choices(common, k=rng.randint(1, 30)) + rng.choices(rare, k=rng.randint(0, 6))
        rng.shuffle(words)
        out.append(rng.choice([" ", "\n", ", ", "\x00"]).join(words))
    return out + out[-20:]


@pytest.mark.parametrize("plan", [
    Plan(), Plan(top=3), Plan(top=10, rare_share=8, window=16, segment_docs=100),
    Plan(top=5, rare_share=100_000, window=7, segment_docs=33), Plan(top=7, rare_share=1, window=64),
    Plan(top=4, rare_share=20, segment_postings=50, block_terms=10)])
def test_against_every_document(spark, plan):
    docs = texts(700, random.Random(5))
    items = [(i, " ".join(RNG.choices(docs[7:], k=2)) if i % 3 else f"r{i} the r{i + 1}!r{i}") for i in range(25)]
    items += [(100, None), (101, ""), (102, "unknown words only"), (103, "the"), (104, "r1"), (None, "r2 the"),
              (105, "r3"), (105, "r4 the"), (106, "the " * 30_000)]
    frame = corpus(spark, docs).repartition(3)
    found = search(frame, spark.createDataFrame([(*i, "x") for i in items], ITEMS), plan)
    assert [c for c, _ in found.dtypes] == ["item_id", "rank", "doc_id", "score"]
    assert got(found) == plain(list(enumerate(docs)), items, plan.top)


def test_ties_null_and_repeated_ids(spark):
    rows = [(i, "same words") for i in range(90, 0, -1)] + [(None, "same words"), (7, "same words"), (3, "other")]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id LONG, text STRING, term STRING, at STRING")
    items = [(1, "same"), (2, "other same")]
    for top in (5, 200):
        found = search(docs, spark.createDataFrame([(*i, "x") for i in items], ITEMS), Plan(top=top, window=8))
        assert got(found) == plain(rows, items, top)


def test_empty_tables(spark):
    docs, none = corpus(spark, ["a b", "c"]), spark.createDataFrame([], ITEMS)
    one = spark.createDataFrame([(1, "a", "x")], ITEMS)
    assert search(docs, none).count() == search(corpus(spark, []), one).count() == 0
    assert search(corpus(spark, [None, "", "!"]), one).count() == 0


def test_terms_are_those_of_the_pattern(spark):
    odd = ["".join(map(chr, range(0, 300))), "İstanbul K ß \x85\xa0x", "a\U0001d11eb", "A1b2_C3", "퟿￿"]
    rows = item_terms(spark.createDataFrame(list(enumerate(odd)), "item_id LONG, text STRING")).collect()
    for i, text in enumerate(odd):
        assert sorted(r["term"] for r in rows if r["item_id"] == i) == sorted(set(terms(text)))


def test_segments_hold_every_document_once(spark):
    docs = texts(300, random.Random(6))
    rows = segments(corpus(spark, docs).repartition(2), Plan(segment_docs=40)).collect()
    own = [r for r in rows if r["term"] == ""]
    assert sorted(i for r in own for i in r["ids"]) == list(range(len(docs)))
    assert all(len(r["ids"]) <= 40 for r in own)
    assert sum(r["words"] for r in own) == sum(len(terms(t)) for t in docs)
    assert sum(r["docs"] for r in own) == sum(1 for t in docs if terms(t))


def test_floor_is_below_the_kth_value_and_near_it(spark):
    rng = random.Random(1)
    values = {g: [rng.randint(1, 10**9) for _ in range(n)] for g, n in ((1, 400), (2, 50), (3, 49), (None, 60))}
    rows = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g LONG, v LONG")
    floors = {r["g"]: r["floor"] for r in _kth_floor(rows, "g", "v", 50).collect()}
    assert set(floors) == {1, 2, None}
    for g, floor in floors.items():
        kth = sorted(values[g], reverse=True)[49]
        assert floor <= kth <= floor * 1.01
