"""Resolution of not-modified revisits in crawl records.

A revisit answered "not modified" has no body. It refers to the latest full response, strictly
earlier, of the same canonical URL; the reference holds if the revisit's validators agree with
that response's, and the stored headers are then updated with those the revisit may change.

The as-of join sorts records by URL and time across the cluster. Inside a stored partition a
window finds the latest response of the URL; one row for each partition carries its last
response to the following ones. A URL that a third of all records share is thus spread over as
many partitions as its records fill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cargolens.session import stage

# Fields that a 304 answer may update (RFC 9110, 15.4.5, and Last-Modified).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*://"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www, default port and user; path without trailing slashes;
    query fields sorted, without tracking fields. Scheme and fragment go. No host: null."""
    plain = F.trim(F.regexp_replace(url, "(?s)#.*$", ""))
    host = F.lower(F.regexp_extract(plain, _SCHEME + "([^/?]*)", 1))
    for pattern in ("^.*@", ":(80|443)?$", r"^www\."):
        host = F.regexp_replace(host, pattern, "")
    path = F.regexp_replace(F.regexp_extract(plain, _SCHEME + "[^/?]*([^?]*)", 1), "/+$", "")
    fields = F.filter(F.split(F.regexp_extract(plain, r"(?s)\?(.*)$", 1), "&"),
                      lambda f: (f != "") & ~f.rlike(TRACKING))
    query = F.array_join(F.array_sort(fields), "&")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query))
                                       .otherwise("")))


def header(headers: Column, name: str) -> Column:
    """First value of a field, whatever the case of its name."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name), F.lit(0))["value"]


def merged_headers(stored: Column, fresh: Column) -> Column:
    """Stored fields, those that the revisit brings and may change replaced by its own."""
    allowed = F.filter(F.coalesce(fresh, F.array().cast("array<struct<name:string,value:string>>")),
                       lambda h: F.lower(h["name"]).isin(PERMITTED))
    names = F.transform(allowed, lambda h: F.lower(h["name"]))
    return F.concat(F.filter(stored, lambda h: ~F.coalesce(F.array_contains(
        names, F.lower(h["name"])), F.lit(False))), allowed)


def _weak(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def latest_earlier(records: DataFrame, value: list[str]) -> DataFrame:
    """The records (key, at, full, and others) that aren't full, with ``earlier``: a struct of
    ``value`` of the latest full record of the same key with a smaller ``at``, or null.

    Of full records equal in key and time the one with the greatest record_id counts. A record
    without a key or time is neither found nor finds one.
    """
    place = ["key", "at", "full", "record_id"]
    part = "__part"
    rows = stage(records.repartitionByRange(*place).sortWithinPartitions(*place)
                 .withColumn(part, F.spark_partition_id()), "revisit-sorted")
    usable = F.col("full") & F.col("key").isNotNull() & F.col("at").isNotNull()
    found = F.when(usable, F.struct("key", *value))
    # Before a full record come the others of its time: the order of ``full``, false first.
    within = (Window.partitionBy(part, "key").orderBy("at", "full", "record_id")
              .rowsBetween(Window.unboundedPreceding, -1))
    ends = rows.where(usable).groupBy(part).agg(
        F.max(F.struct(*place, F.struct("key", *value).alias("last")))["last"].alias("last"))
    every = rows.select(part).distinct().join(ends, part, "left")
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select(F.col(part).alias("__at_part"),
                           F.last("last", ignorenulls=True).over(before).alias("__carried"))
    near = rows.withColumn("__near", F.last(found, ignorenulls=True).over(within)).where("NOT full")
    joined = near.join(F.broadcast(carried), F.col(part) == F.col("__at_part"))  # a row a partition
    earlier = F.coalesce("__near", F.when(F.col("__carried")["key"] == F.col("key"), F.col("__carried")))
    return joined.withColumn("earlier", F.when(
        F.col("key").isNotNull() & F.col("at").isNotNull(), earlier)).drop(
        part, "__at_part", "__near", "__carried")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, key, refers_to, outcome, headers (merged), payload_chars,
    payload_sha256.

    ``records``: record_id, url, at (seconds), full, headers (array of name and value), and of full
    ones payload_chars and payload_sha256. ``outcome`` is resolved; unverified (the revisit has
    neither ETag nor Last-Modified); mismatch (they differ from the response's); or missing (no
    earlier response). Only resolved ones take the payload and the merged headers, the others
    keep their own. An ETag decides by weak comparison; without one Last-Modified does. Repeated
    records are records like others. Null headers are no headers.
    """
    none = F.array().cast("array<struct<name:string,value:string>>")
    keyed = records.select("record_id", canonical_url(F.col("url")).alias("key"), "at",
                           F.coalesce("full", F.lit(False)).alias("full"),
                           F.coalesce("headers", none).alias("headers"),
                           "payload_chars", "payload_sha256")
    keyed = stage(keyed, "revisit-records")
    value = ["record_id", "headers", "payload_chars", "payload_sha256"]
    rows = latest_earlier(keyed, value)
    old, new = F.col("earlier")["headers"], F.col("headers")
    tag, modified = header(new, "etag"), header(new, "last-modified")
    agrees = F.when(tag.isNotNull(), _weak(tag).eqNullSafe(_weak(header(old, "etag")))).otherwise(
        modified.eqNullSafe(header(old, "last-modified")))
    outcome = (F.when(F.col("earlier").isNull(), "missing")
               .when(tag.isNull() & modified.isNull(), "unverified")
               .when(agrees, "resolved").otherwise("mismatch"))
    rows = rows.withColumn("outcome", outcome)
    sound = F.col("outcome") == "resolved"
    return rows.select(
        "record_id", "key", F.col("earlier")["record_id"].alias("refers_to"), "outcome",
        F.when(sound, merged_headers(old, new)).otherwise(new).alias("headers"),
        *[F.when(sound, F.col("earlier")[c]).alias(c) for c in ("payload_chars", "payload_sha256")])


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Crawl records for a table of pages: each page as fetched, a minute after the one before, and
    a visit some hours later that was answered "not modified".

    The later answers differ as servers' do: by page_id some bring a changed ETag, a weak one, only
    Last-Modified, or no validator at all.
    """
    def field(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))

    html, page = F.coalesce("html", F.lit("")), F.col("page_id")
    at = F.lit(1_704_067_200) + 60 * page
    tag = F.concat(F.lit('"'), F.substring(F.md5(html), 1, 16), F.lit('"'))
    response = pages.select(
        (2 * page).alias("record_id"), "url", at.alias("at"), F.lit(True).alias("full"),
        F.array(field("Content-Type", F.lit("text/html")), field("ETag", tag), field("Last-Modified", at),
                field("Cache-Control", F.lit("max-age=60")),
                field("Content-Length", F.octet_length(html))).alias("headers"),
        F.char_length(html).cast("long").alias("payload_chars"), F.sha2(html, 256).alias("payload_sha256"))
    later = at + 3600 * (1 + page % 7) + 1
    common = [field("Date", later), field("cache-control", F.lit("max-age=600")),
              field("Content-Length", F.lit(0))]
    headers = (F.when(page % 13 == 0, F.array(*common))
               .when(page % 11 == 0, F.array(*common, field("last-modified", at)))
               .when(page % 5 == 0, F.array(*common, field("ETag", F.lit('"changed"'))))
               .when(page % 3 == 0, F.array(*common, field("etag", F.concat(F.lit("W/"), tag))))
               .otherwise(F.array(*common, field("ETag", tag))))
    revisit = pages.select(
        (2 * page + 1).alias("record_id"), F.concat("url", F.lit("#again")).alias("url"),
        later.alias("at"), F.lit(False).alias("full"), headers.alias("headers"),
        F.lit(None).cast("long").alias("payload_chars"), F.lit(None).cast("string").alias("payload_sha256"))
    return response.union(revisit)
