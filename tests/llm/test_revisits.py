import random

from pyspark.sql import functions as F

from cargolens.llm.revisits import (PERMITTED, canonical_url, latest_earlier, records_of_pages,
                                    resolve_revisits)

RECORD = ("record_id LONG, url STRING, at LONG, full BOOLEAN, "
          "headers ARRAY<STRUCT<name: STRING, value: STRING>>, payload_chars LONG, "
          "payload_sha256 STRING, extra STRING")


def test_canonical_urls(spark):
    cases = {
        "HTTP://www.Example.com:80/a/?utm_source=x&b=2&a=1#top": "example.com/a?a=1&b=2",
        "https://example.com/a?a=1&b=2": "example.com/a?a=1&b=2",
        "https://user@example.com:8080/": "example.com:8080",
        "https://example.com?ref=x": "example.com", "ftp://h/É/": "h/É",
        "not a url": None, "": None, None: None, "https:///path": None}
    rows = spark.createDataFrame([(u,) for u in cases], "u STRING").select("u", canonical_url(F.col("u")).alias("c"))
    assert {r["u"]: r["c"] for r in rows.collect()} == cases


def test_as_of_join_equals_brute_force_also_for_a_hot_key(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot", "hot", f"k{rng.randrange(60)}", None]),
             rng.choice([None, rng.randrange(400)]), rng.random() < 0.3) for i in range(3000)]
    df = spark.createDataFrame(rows, "record_id LONG, key STRING, at LONG, full BOOLEAN").repartition(6)
    got = {r["record_id"]: r["earlier"] and r["earlier"]["record_id"]
           for r in latest_earlier(df, ["record_id"]).collect()}
    assert set(got) == {i for i, _, _, full in rows if not full}
    for i, key, at, _ in (r for r in rows if not r[3]):
        fits = [(t, j) for j, k, t, full in rows
                if full and key is not None and k == key and at is not None and t is not None and t < at]
        assert got[i] == (max(fits)[1] if fits else None)


def h(*pairs):
    return [{"name": n, "value": v} for n, v in pairs]


def test_validators_and_headers(spark):
    u, v = "http://www.a.org/x", "https://a.org/x/"
    rows = [
        (1, u, 10, True, h(("ETag", '"a"'), ("Content-Length", "5"), ("Vary", "x")), 5, "s1", None),
        (2, v, 20, False, h(("etag", 'W/"a"'), ("Date", "d"), ("Content-Length", "0"), ("vary", "y")), None, None, None),
        (3, u, 30, False, h(("ETag", '"b"')), None, None, None),
        (4, u, 40, True, h(("Last-Modified", "m")), 7, "s4", None),
        (5, u, 50, False, h(("last-modified", "m")), None, None, None),
        (6, u, 60, False, None, None, None, None), (7, u, 10, False, h(("ETag", '"a"')), None, None, None),
        (8, None, 99, False, h(("ETag", '"a"')), None, None, None),
        (9, u, 70, False, h(("ETag", '"a"')), None, None, None)]
    got = {r["record_id"]: r for r in resolve_revisits(spark.createDataFrame(rows, RECORD)).collect()}
    assert {i: (r["outcome"], r["refers_to"], r["payload_sha256"]) for i, r in got.items()} == {
        2: ("resolved", 1, "s1"), 3: ("mismatch", 1, None), 5: ("resolved", 4, "s4"),
        6: ("unverified", 4, None), 7: ("missing", None, None), 8: ("missing", None, None),
        9: ("mismatch", 4, None)}
    assert [tuple(x) for x in got[2]["headers"]] == [
        ("Content-Length", "5"), ("etag", 'W/"a"'), ("Date", "d"), ("vary", "y")]
    assert all(n == n.lower() for n in PERMITTED)


def test_empty_and_null_pages(spark):
    schema = "page_id LONG, url STRING, html STRING"
    assert resolve_revisits(records_of_pages(spark.createDataFrame([], schema))).count() == 0
    pages = spark.createDataFrame([(None, None, None), (1, "http://a/b", None), (1, "http://a/b", None)], schema)
    assert sorted(r["outcome"] for r in resolve_revisits(records_of_pages(pages)).collect()) == [
        "missing", "resolved", "resolved"]
