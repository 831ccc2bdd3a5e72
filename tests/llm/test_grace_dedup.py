import hashlib
import random
import re

from cargolens.llm.grace_dedup import ContentTable, duplicate_groups, exact_dedup

from .helpers import DOCS, corpus


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        text = text or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((-len(text), doc_id))
    out = {}
    for content, members in groups.items():
        keep = min(members)[1]
        for _, doc_id in members:
            out[doc_id] = (keep, len(members), doc_id == keep,
                           hashlib.sha256(content.encode()).hexdigest())
    return out


def check(spark, texts, bucket_bytes):
    docs = corpus(spark, texts).repartition(5)
    want = expected(list(enumerate(texts)))
    got = {r["doc_id"]: tuple(r)[1:] for r in duplicate_groups(docs, bucket_bytes).collect()}
    assert got == want
    kept = exact_dedup(docs, bucket_bytes)
    assert kept.columns == docs.columns
    rows = {tuple(r) for r in kept.collect()}
    assert rows == {tuple(r) for r in docs.collect() if want[r["doc_id"]][2]}


def test_copies_spacing_nulls_and_long_texts(spark):
    random.seed(1)
    texts = ["a b", "ab", " a\tb ", None, "", " \n", "a b", "é b", "éb", "x" * 300_000]
    texts += [random.choice(["same text", "sametext ", "other", "𝄞 x"]) for _ in range(400)]
    check(spark, texts, 48 << 20)


def test_crowded_buckets_are_dealt_again(spark):
    check(spark, [f"text {i % 170} " + "y" * (i % 170) for i in range(500)], 900)


def test_empty_table_and_repeated_rows(spark):
    assert exact_dedup(spark.createDataFrame([], DOCS)).count() == 0
    assert duplicate_groups(spark.createDataFrame([], DOCS)).count() == 0
    twice = spark.createDataFrame([(7, "t", None, None, 1, "x")] * 3 + [(None, "t", None, None, 1, "x")],
                                  DOCS)
    got = duplicate_groups(twice).collect()
    assert [r["keep_id"] for r in got] == [7] * 4 and sum(r["kept"] for r in got) == 1
    assert exact_dedup(twice).count() == 1


def test_table_compares_contents_not_hashes():
    table = ContentTable()
    digest = bytes(32)
    assert [table.find_or_add(digest, b"%d" % (i % 300)) for i in range(600)] == [
        i % 300 for i in range(600)]
