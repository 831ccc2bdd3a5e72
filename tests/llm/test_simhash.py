import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from cargolens.llm.simhash import (Plan, _joining, _meetings, _near, fingerprints, hex_digits, index_lists,
                                   links, near_duplicates, shared_bytes)
from tests.llm.helpers import corpus

RNG = random.Random(12)
WORDS = [f"w{i}" for i in range(300)] + ["Été", "ß", "中文", "𝄞"]


def plain_fingerprint(text):
    words = [w for w in (text or "").translate(
        {c: c + 32 for c in range(65, 91)} | {c: 32 for c in range(9, 14)}).split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids, distance=2):
    below = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= distance and below[j] > below[i]:
                    below[j], changed = below[i], True
    return [min(ids[k] for k in range(len(ids)) if below[k] == below[i]) for i in range(len(ids))]


def texts():
    out = [None, "", " \t\n", "one", "ONE", "one two", "One\x0btwo", "a b c", "a b c", "ÉTÉ été"]
    for _ in range(25):
        base = RNG.choices(WORDS, k=RNG.randint(40, 120))
        for _ in range(5):
            copy = list(base)
            for _ in range(RNG.randint(0, 3)):
                copy[RNG.randrange(len(copy))] = RNG.choice(WORDS)
            out.append(RNG.choice([" ", "\n", " \t "]).join(copy))
    return out + ["again and again " * 60_000, "again and again " * 60_000]


def test_documents_against_brute_force(spark):
    all_texts = texts()
    docs = corpus(spark, all_texts, first=100).repartition(5)
    prints = [plain_fingerprint(t) for t in all_texts]
    ids = list(range(100, 100 + len(all_texts)))
    expected = plain_components(prints, ids)
    assert len(set(expected)) < len(set(prints))      # some links lie between different fingerprints
    got = {r["doc_id"]: r for r in near_duplicates(docs).withColumn("hex", hex_digits("fingerprint")).collect()}
    assert len(got) == len(ids)
    for doc_id, p, c in zip(ids, prints, expected):
        assert (got[doc_id]["hex"], got[doc_id]["component_id"]) == (f"{p:016x}", c)
        assert got[doc_id]["kept"] == (doc_id == c)


def near_prints(n, flips, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(max(1, n // 50))]
    out = {0, 1, 3, (1 << 64) - 1, 1 << 63}
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randint(0, flips)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_connect_what_lies_near(spark):
    prints = near_prints(600, 7, 3)
    nodes = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint LONG")
    for distance in (1, 2):
        plan = Plan(distance=distance)
        got = [(r["a"] % 2**64, r["b"] % 2**64) for r in links(nodes, plan).collect()]
        assert all((a ^ b).bit_count() <= distance for a, b in got)
        place = {p: i for i, p in enumerate(prints)}
        label = list(range(len(prints)))
        changed = True
        while changed:
            changed = False
            for a, b in got:
                low = min(label[place[a]], label[place[b]])
                for p in (a, b):
                    if label[place[p]] != low:
                        label[place[p]], changed = low, True
        assert [prints[x] for x in label] == plain_components(prints, prints, distance)


def test_a_pair_meets_as_often_as_its_shared_bytes_say(spark):
    a, b, c = 0x1122334455667788, 0x1122334455667789, 0x1122334455667688 ^ 1
    far = a ^ 0x0101010000000000
    nodes = spark.createDataFrame([(x,) for x in (a, b, c, far)], "fingerprint LONG")
    lists = [set(r["members"]) for r in index_lists(nodes, Plan()).collect()]
    assert sum({a, b} <= m for m in lists) == 7 and sum({a, c} <= m for m in lists) == 1
    assert not any({a, far} <= m for m in lists)
    pairs = spark.createDataFrame([(a, b), (a, c), (a, far), (a, a), (-1, 0)], "a LONG, b LONG")
    assert [r[0] for r in pairs.select(shared_bytes("a", "b")).collect()] == [7, 6, 5, 8, 0]


def test_links_of_a_list_grow_with_its_members(spark):
    for n in (300, 600):
        low = random.Random(5).sample(range(1 << 16), n)
        members = np.sort(np.array(low, np.uint64) << np.uint64(16))
        near = _near((2, 3), 2)
        assert len(near) == 136
        meetings = set(_meetings(members, near))
        expected = {(i, j) for i in range(n) for j in range(i + 1, n)
                    if int(members[i] ^ members[j]).bit_count() <= 2}
        assert meetings == expected
        assert len(list(_joining(members, near))) < n


def test_full_list(spark):
    members = np.arange(1 << 16, dtype=np.uint64)
    assert len(list(_joining(members, _near((0, 1), 2)))) == (1 << 16) - 1


def test_empty_table_null_ids_and_repeated_rows(spark):
    assert near_duplicates(corpus(spark, [])).count() == 0
    schema = "doc_id LONG, text STRING, fingerprint STRING, component_id STRING, members STRING"
    rows = [(None, "a b c d", "x", "y", "z"), (5, "a b c d", None, None, None), (5, "a b c d", "x", "y", "z"),
            (None, "quite another text altogether", "x", "y", "z"), (9, None, "x", "y", "z"), (8, "", "x", "y", "z")]
    got = near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [
        (0, 0), (0, 5), (5, 5), (5, 5), (8, 8), (9, 8)]


def test_fingerprints_agree_with_the_engine_hash(spark):
    one = fingerprints(corpus(spark, ["just three words"])).first()["fingerprint"]
    assert one == spark.range(1).select(F.xxhash64(F.lit("just three words"))).first()[0]
