"""Exact dedup by Grace hash partitioning.

Records are dealt into buckets by the hash of their content and written to the shared folder; a
bucket whose different contents don't fit a table is dealt again with another hash, until each
one fits. Then each bucket is read by one task into an open-addressing table that compares
complete contents. A content that a third of all rows share is reduced before it is dealt: each
batch of the scan keeps one record of it, with the count and the best row, so a bucket streams
one record for each batch and holds one.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (BinaryType, BooleanType, LongType, StructField, StructType)

from cargolens.llm.common import SPACE_BYTES, small_batches
from cargolens.session import stage

BUCKET_BYTES = 48 << 20  # different contents that one table may hold
MAX_LEVELS = 8


class ContentTable:
    """Open addressing with linear probing; equal means equal in all bytes."""

    def __init__(self) -> None:
        self.slots = array("q", [-1]) * 64
        self.contents: list[bytes] = []
        self.hashes = array("Q")

    def find_or_add(self, digest: bytes, content: bytes) -> int:
        """Number of the group of this content; the next number if it is new."""
        if 2 * (len(self.contents) + 1) > len(self.slots):
            self._grow()
        value, mask = int.from_bytes(digest[8:16], "little"), len(self.slots) - 1
        at = value & mask
        while (group := self.slots[at]) >= 0:
            if self.hashes[group] == value and self.contents[group] == content:
                return group
            at = (at + 1) & mask
        self.slots[at] = len(self.contents)
        self.contents.append(content)
        self.hashes.append(value)
        return self.slots[at]

    def _grow(self) -> None:
        self.slots = array("q", [-1]) * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for group, value in enumerate(self.hashes):
            at = value & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = group


def _content(text: bytes | None) -> bytes:
    return (text or b"").translate(None, SPACE_BYTES)


def _rank(chars: int, doc_id: int | None) -> tuple[int, bool, int]:
    """Greater is better: most code points, then the smallest id, no id last."""
    return chars, doc_id is not None, -(doc_id or 0)


def _collapse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document; the best row of each content of the batch carries the record."""
    base = TaskContext.get().partitionId() << 40
    for batch in batches:
        ids, chars, texts = (batch.column(i).to_pylist() for i in range(3))
        found, best, count, group_of, digests = ContentTable(), [], [], [], []
        for i, text in enumerate(texts):
            content = _content(text)
            digest = hashlib.sha256(content).digest()
            group = found.find_or_add(digest, content)
            if group == len(best):
                best.append(i)
                count.append(0)
            elif _rank(chars[i], ids[i]) > _rank(chars[best[group]], ids[best[group]]):
                best[group] = i
            count[group] += 1
            group_of.append(group)
            digests.append(digest)
        carrier = {row: group for group, row in enumerate(best)}
        take = pa.array([i if i in carrier else None for i in range(len(ids))], pa.int64())
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(chars, pa.int64()), pa.array(digests, pa.binary()),
            pa.array([base + best[g] for g in group_of], pa.int64()),
            pa.array([count[carrier[i]] if i in carrier else None for i in range(len(ids))],
                     pa.int64()),
            batch.column(3).take(take)],
            names=["doc_id", "chars", "digest", "record", "copies", "row"])
        base += len(ids)


class _Bucket:
    """Groups of one bucket: a table and, for each group, its best record and its size."""

    def __init__(self) -> None:
        self.table = ContentTable()
        self.best: list[tuple] = []   # rank, doc_id, record, row
        self.size = array("q")
        self.records, self.groups = array("q"), array("q")

    def add(self, digest, text, chars, doc_id, copies, record, row) -> None:
        group = self.table.find_or_add(digest, _content(text))
        candidate = (_rank(chars, doc_id), doc_id, record, row)
        if group == len(self.best):
            self.best.append(candidate)
            self.size.append(0)
        elif (candidate[0], -record) > (self.best[group][0], -self.best[group][2]):
            self.best[group] = candidate
        self.size[group] += copies
        self.records.append(record)
        self.groups.append(group)

    def out(self, row_type: pa.DataType, with_rows: bool, step: int = 2000
            ) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(self.records), step):
            records, groups = self.records[start:start + step], self.groups[start:start + step]
            best = [self.best[g] for g in groups]
            won = [b[2] == r for b, r in zip(best, records)]
            rows = ([b[3].as_py() if w else None for b, w in zip(best, won)] if with_rows
                    else [None] * len(won))
            yield pa.RecordBatch.from_arrays([
                pa.array(records, pa.int64()), pa.array([b[1] for b in best], pa.int64()),
                pa.array([self.size[g] for g in groups], pa.int64()), pa.array(won, pa.bool_()),
                pa.array(rows, row_type)],
                names=["record", "keep_id", "group_size", "won", "row"])


def _resolver(with_rows: bool):
    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, name, row_type = _Bucket(), None, None
        for batch in batches:
            row_type = batch.schema.field("row").type
            rows = batch.column(batch.schema.get_field_index("row"))
            texts = rows.field("text").cast(pa.binary()).to_pylist()
            kept = rows if with_rows else [None] * len(texts)
            cols = [batch.column(i).to_pylist() for i in range(6)]
            for i, (at, digest, chars, doc_id, copies, record) in enumerate(zip(*cols)):
                if at != name:
                    yield from bucket.out(row_type, with_rows)
                    bucket, name = _Bucket(), at
                bucket.add(digest, texts[i], chars, doc_id, copies, record, kept[i])
        if row_type is not None:
            yield from bucket.out(row_type, with_rows)
    return resolve


def _spill(docs: DataFrame) -> DataFrame:
    """Write one row per document, with the whole record at one row of each batch and content."""
    small_batches(docs.sparkSession)
    row = F.struct(*docs.columns)
    source = docs.select(F.col("doc_id").cast("long"),
                         F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("chars"),
                         F.coalesce("text", F.lit("")).cast("binary").alias("content"),
                         row.alias("row"))
    schema = StructType([
        StructField("doc_id", LongType()), StructField("chars", LongType()),
        StructField("digest", BinaryType()), StructField("record", LongType()),
        StructField("copies", LongType()),
        StructField("row", StructType(source.schema["row"].dataType.fields))])
    return stage(source.mapInArrow(_collapse_batches, schema), "grace-records")


def _deal(records: DataFrame, bucket_bytes: int) -> tuple[DataFrame, int]:
    """Add ``bucket``. Only digests and lengths are read until every bucket fits."""
    sizes = (records.groupBy("digest").agg(F.max(F.octet_length("row.text")).alias("bytes"))
             .withColumn("bytes", F.coalesce("bytes", F.lit(0))))
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    count = max(1, -(-2 * total // bucket_bytes))  # aim at half, so that few are dealt again
    levels = [lambda df: df.withColumn(
        "bucket", F.pmod(F.xxhash64("digest", F.lit(0)), F.lit(count)).cast("string"))]
    for level in range(1, MAX_LEVELS):
        dealt = reduce(lambda df, f: f(df), levels, sizes)
        crowded = (dealt.groupBy("bucket").agg(F.sum("bytes").alias("held"), F.count("*").alias("n"))
                   .where((F.col("held") > bucket_bytes) & (F.col("n") > 1))
                   .select(F.col("bucket").alias("__full"),
                           F.ceil(2 * F.col("held") / bucket_bytes).alias("__parts")))
        crowded = stage(crowded, "grace-crowded")
        if crowded.isEmpty():
            break
        count += crowded.agg(F.sum("__parts")).first()[0]
        levels.append(lambda df, crowded=crowded, level=level: df.join(
            crowded, F.col("bucket") == F.col("__full"), "left").withColumn(
            "bucket", F.when(F.col("__full").isNull(), F.col("bucket")).otherwise(F.concat_ws(
                ".", "bucket", F.pmod(F.xxhash64("digest", F.lit(level)), F.col("__parts")))))
            .drop("__full", "__parts"))
    return reduce(lambda df, f: f(df), levels, records), count


def _resolve(spilled: DataFrame, bucket_bytes: int, with_rows: bool) -> DataFrame:
    records, count = _deal(spilled.where(F.col("copies").isNotNull()), bucket_bytes)
    row_type = spilled.schema["row"].dataType
    schema = StructType([
        StructField("record", LongType()), StructField("keep_id", LongType()),
        StructField("group_size", LongType()), StructField("won", BooleanType()),
        StructField("row", row_type)])
    dealt = (records.select("bucket", "digest", "chars", "doc_id", "copies", "record", "row")
             .repartition(count, "bucket").sortWithinPartitions("bucket"))
    return dealt.mapInArrow(_resolver(with_rows), schema)


def exact_dedup(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are: of the texts that are equal
    without white space, the one with the most code points, then the smallest doc_id.

    A null text counts as empty, and all empty texts are one group. A null doc_id comes after
    any other; of rows equal in both, one stays. Other columns may be null or have any name.
    """
    kept = _resolve(_spill(docs), bucket_bytes, with_rows=True).where("won")
    return kept.select("row.*")


def duplicate_groups(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (of the row that stays), group_size, kept,
    text_sha256 (of the text without white space). Same rules as ``exact_dedup``."""
    spilled = _spill(docs.select("doc_id", "text"))
    groups = stage(_resolve(spilled, bucket_bytes, with_rows=False).drop("row"), "grace-groups")
    members = spilled.select("doc_id", "digest", "record", F.col("copies").isNotNull().alias("best"))
    return members.join(groups, "record").select(
        "doc_id", "keep_id", "group_size", (F.col("best") & F.col("won")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
