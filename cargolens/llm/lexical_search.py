"""Ranked lexical search: accumulators for an item's rare terms, skipping over its frequent ones.

One scan builds an inverted index in segments of some thousand documents, keeping the terms that
some item asks for. Then, for a block of items:

* term at a time, the lists of rare terms are summed into accumulators, stored per segment; the
  k-th highest accumulator of an item is a floor for its results before any frequent list is read;
* document at a time, an item's accumulators are one more iterator beside its frequent lists, with
  a bound like theirs. Windows of documents whose bounds don't add up to the floor are skipped. In
  the others the iterators are taken by falling bound, and as soon as what is left can't lift a new
  document to the floor, the remaining lists are only probed for the documents still in play.

Floors rise with every document found. Nothing is dropped that could be among the results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from cargolens.llm.common import small_batches, text_bytes
from cargolens.session import stage

ROWS = 20_000    # rows of a segment handed over at a time


@dataclass(frozen=True)
class Plan:
    """A term counts as rare if it is in at most one of ``rare_share`` documents. A segment ends with
    the document that reaches one of its two numbers; a window is so many documents of a segment, a
    block so many terms of items on average. None of these changes a result. ``length_percent``
    and ``saturation`` are numbers of the formula: weight of a document's length, and how soon
    further occurrences cease to count."""

    top: int = 50
    rare_share: int = 256
    segment_docs: int = 4096
    segment_postings: int = 1 << 20
    window: int = 512
    block_terms: int = 200_000
    length_percent: int = 50
    saturation: int = 20


# --- terms ------------------------------------------------------------------------

# A term is a maximal run of ASCII letters and digits and of bytes above ASCII; A-Z lower-cased.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def _terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, t) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for t in set(_terms(text))]
            ids, found = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(found, pa.binary()).cast(pa.string())],
                names=["item_id", "term"])

    source = items.select(F.col("item_id").cast("long"), text_bytes("text").alias("text"))
    return source.mapInArrow(run, "item_id long, term string").distinct()


# --- the index --------------------------------------------------------------------

class _Segment:
    """Documents of one segment, turned into a row for each term."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.numbers: dict[bytes, int] = {}
        self.held: list[list[int]] = []
        self.times: list[list[int]] = []
        self.postings = 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        words = _terms(text)
        counts = Counter(words)
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.held.append([self.numbers.setdefault(t, len(self.numbers)) for t in counts])
        self.times.append(list(counts.values()))
        self.postings += len(counts)

    def batches(self, part: int) -> Iterator[pa.RecordBatch]:
        lengths = np.array(self.lengths, "<u4")
        yield _index_rows(part, [b""], [int((lengths > 0).sum())], int(lengths.sum(dtype=np.int64)),
                          self.ids, lengths.tobytes(), [b""], [b""])
        numbers = np.fromiter((n for held in self.held for n in held), np.int64, self.postings)
        times = np.fromiter((n for t in self.times for n in t), "<u4", self.postings)
        at = np.repeat(np.arange(len(self.ids), dtype="<u4"), [len(h) for h in self.held])
        order = np.argsort(numbers, kind="stable")     # documents stay in order within a term
        at, times = at[order], times[order]
        ends = np.cumsum(np.bincount(numbers, minlength=len(self.numbers)))
        starts = np.concatenate([[0], ends[:-1]])
        terms = list(self.numbers)
        for k in range(0, len(terms), ROWS):
            cuts = list(zip(starts[k:k + ROWS].tolist(), ends[k:k + ROWS].tolist()))
            yield _index_rows(part, terms[k:k + ROWS], [b - a for a, b in cuts], None, None, None,
                              [at[a:b].tobytes() for a, b in cuts],
                              [times[a:b].tobytes() for a, b in cuts])


INDEX = ("part long, term string, docs long, words long, ids array<long>, lengths binary, "
         "at binary, tf binary")


def _index_rows(part: int, terms: list, docs: list, words, ids, lengths, at: list, tf: list) -> pa.RecordBatch:
    n = len(terms)
    return pa.RecordBatch.from_arrays(
        [pa.array([part] * n, pa.int64()), pa.array(terms, pa.binary()).cast(pa.string()),
         pa.array(docs, pa.int64()), pa.array([words] * n, pa.int64()),
         pa.array([ids] * n, pa.list_(pa.int64())), pa.array([lengths] * n, pa.binary()),
         pa.array(at, pa.binary()), pa.array(tf, pa.binary())],
        names=["part", "term", "docs", "words", "ids", "lengths", "at", "tf"])


def segments(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Rows (part, term, docs, words, ids, lengths, at, tf): for each segment one row with the empty
    term that has its documents, and one for each term, ``at`` being the places of the documents
    that hold it and ``tf`` how often (little-endian 32-bit numbers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment = TaskContext.get().partitionId() << 32, _Segment()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                segment.add(doc_id, text)
                if len(segment.ids) >= plan.segment_docs or segment.postings >= plan.segment_postings:
                    yield from segment.batches(part)
                    part, segment = part + 1, _Segment()
        if segment.ids:
            yield from segment.batches(part)

    return docs.select(F.col("doc_id").cast("long"), text_bytes("text").alias("text")).mapInArrow(run, INDEX)


def _index(docs: DataFrame, asked: DataFrame, plan: Plan) -> DataFrame:
    """The stored index of the terms in ``asked``. Whether these are sent to every task is the
    planner's decision by their size."""
    every = asked.select("term").distinct().union(docs.sparkSession.createDataFrame([("",)], "term string"))
    return stage(segments(docs, plan).join(every, "term", "left_semi").select(
        "part", "term", "docs", "words", "ids", "lengths", "at", "tf"), "search-index")


# --- one segment in a task --------------------------------------------------------

@dataclass
class _Block:
    """A block of items: what each asks for. ``terms`` maps a term to its number."""

    items: list[int | None]
    terms: dict[str, int]
    weights: np.ndarray
    rare: np.ndarray
    asked: list[np.ndarray]
    plan: Plan
    documents: int
    words: int
    by_rare_term: dict[int, list[int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for item, numbers in enumerate(self.asked):
            for t in numbers[self.rare[numbers]].tolist():
                self.by_rare_term.setdefault(t, []).append(item)

    def length_factors(self, lengths: bytes) -> np.ndarray:
        share = self.plan.length_percent
        n = np.frombuffer(lengths, "<u4").astype(np.int64)
        return 100 - share + (share * n * self.documents) // max(self.words, 1)

    def gains(self, term: int, at: np.ndarray, tf: bytes, factors: np.ndarray) -> np.ndarray:
        """What the term adds to the score of each document in its list."""
        times = np.frombuffer(tf, "<u4").astype(np.int64)
        return self.weights[term] * (1_000_000_000 * times //
                                     (1000 * times + self.plan.saturation * factors[at]))


class _Iterator:
    """Documents with gains, ascending, and the highest gain of each window."""

    def __init__(self, at: np.ndarray, gains: np.ndarray, edges: np.ndarray) -> None:
        self.at, self.gains, self.edges = at, gains, edges
        self.starts = np.searchsorted(at, edges)
        self.bounds = np.zeros(len(edges) - 1, np.int64)
        np.maximum.at(self.bounds, at // edges[1], gains)

    def add_all(self, window: int, sums: np.ndarray) -> None:
        cut = slice(self.starts[window], self.starts[window + 1])
        sums[self.at[cut] - self.edges[window]] += self.gains[cut]

    def probe(self, window: int, sums: np.ndarray, wanted: np.ndarray) -> None:
        """Skip to each of the ``wanted`` documents."""
        low, high = self.starts[window], self.starts[window + 1]
        place = low + np.searchsorted(self.at[low:high], wanted + self.edges[window])
        there = np.minimum(place, high - 1)
        met = self.at[there] == wanted + self.edges[window]
        sums[wanted[met]] += self.gains[there[met]]


class _Results:
    """The best documents of an item so far, equal scores by doc_id, null last."""

    def __init__(self, floor: int, top: int) -> None:
        self.floor, self.top = max(floor, 1), top
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.nulls = np.empty(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores, ids, nulls = (np.concatenate(x) for x in (
            (self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
        best = np.lexsort((ids, nulls, -scores))[:self.top]
        self.scores, self.ids, self.nulls = scores[best], ids[best], nulls[best]
        if len(best) == self.top:
            self.floor = max(self.floor, int(self.scores[-1]))


def _windows(iterators: list[_Iterator], results: _Results, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first document, sums) of the windows that can hold a result; sums below the floor may be
    incomplete."""
    bounds = np.stack([i.bounds for i in iterators])
    total = bounds.sum(axis=0)
    for window in np.flatnonzero(total >= results.floor).tolist():
        left = int(total[window])
        if left < results.floor:
            continue
        sums = np.zeros(width, np.int64)
        for k in np.argsort(-bounds[:, window], kind="stable").tolist():
            bound = int(bounds[k, window])
            if not bound:
                break
            if left >= results.floor:      # a document found only from here on may still get there
                iterators[k].add_all(window, sums)
            else:
                wanted = np.flatnonzero((sums > 0) & (sums + left >= results.floor))
                if not len(wanted):
                    break
                iterators[k].probe(window, sums, wanted)
            left -= bound
        yield window * width, sums


# --- passes over the segments -----------------------------------------------------

LISTS = "array<struct<term:string,at:binary,tf:binary>>"
SEGMENT = f"part long, ids array<long>, lengths binary, lists {LISTS}, "
SUMMED = SEGMENT + "sums array<struct<item:int,at:binary,sums:binary,best:array<long>>>"
_LIST = pa.list_(pa.struct([("term", pa.string()), ("at", pa.binary()), ("tf", pa.binary())]))
_SUMS = pa.list_(pa.struct([("item", pa.int32()), ("at", pa.binary()), ("sums", pa.binary()),
                            ("best", pa.list_(pa.int64()))]))


def _accumulate(row: dict, block: _Block) -> list[dict]:
    """Term at a time: the sums of the rare lists for each item that has one here."""
    factors = block.length_factors(row["lengths"])
    lists = {}
    for entry in row["lists"]:
        term = block.terms[entry["term"]]
        if block.rare[term]:
            at = np.frombuffer(entry["at"], "<u4")
            lists[term] = at, block.gains(term, at, entry["tf"], factors)
    asked: dict[int, list[int]] = {}
    for term in lists:
        for item in block.by_rare_term.get(term, []):
            asked.setdefault(item, []).append(term)
    out = []
    sums = np.zeros(len(factors), np.int64)
    for item, terms in asked.items():
        for term in terms:
            at, gains = lists[term]
            sums[at] += gains
        at = np.unique(np.concatenate([lists[t][0] for t in terms]))
        found = sums[at]
        sums[at] = 0
        top = block.plan.top
        best = found if len(found) <= top else np.partition(found, len(found) - top)[-top:]
        out.append({"item": item, "at": at.astype("<u4").tobytes(), "sums": found.astype("<i8").tobytes(),
                    "best": best[best > 0].tolist()})
    return out


def _rank(row: dict, block: _Block, results: list[_Results]) -> None:
    """Document at a time: the documents of a segment for every item."""
    factors = block.length_factors(row["lengths"])
    width = block.plan.window
    edges = np.arange(0, len(factors) + width, width)
    lists: dict[int, _Iterator] = {}
    for entry in row["lists"]:
        at = np.frombuffer(entry["at"], "<u4").astype(np.int64)
        term = block.terms[entry["term"]]
        lists[term] = _Iterator(at, block.gains(term, at, entry["tf"], factors), edges)
    summed = {s["item"]: s for s in row["sums"]}
    nulls = np.array([i is None for i in row["ids"]])
    ids = np.array([0 if i is None else i for i in row["ids"]], np.int64)
    for item, numbers in enumerate(block.asked):
        iterators = [lists[t] for t in numbers.tolist() if t in lists]
        if item in summed:
            iterators.append(_Iterator(np.frombuffer(summed[item]["at"], "<u4").astype(np.int64),
                                       np.frombuffer(summed[item]["sums"], "<i8"), edges))
        if not iterators:
            continue
        for start, sums in _windows(iterators, results[item], width):
            won = np.flatnonzero(sums >= results[item].floor)
            if len(won):
                results[item].add(sums[won], ids[won + start], nulls[won + start])


def _kth_floor(rows: DataFrame, group: str, value: str, k: int) -> DataFrame:
    """(group, floor): a number that at least k values of the group reach, within a hundredth of the
    k-th highest. Values are counted by their 8 highest bits, so a group has a few hundred counts
    however many values; groups with fewer than k values are left out."""
    v = F.col(value)
    bits = F.greatest(F.lit(0), F.length(F.bin(v)) - 8).cast("int")
    low = F.call_function("shiftleft", F.call_function("shiftright", v, bits), bits)
    counts = rows.groupBy(group, low.alias("floor")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(group).orderBy(F.desc("floor")))
    return counts.withColumn("upto", upto).where(F.col("upto") >= k).groupBy(group).agg(
        F.max("floor").alias("floor"))


def _ranked_block(index: DataFrame, queries: DataFrame, plan: Plan, documents: int, words: int) -> DataFrame:
    """(item_id, doc_id, score) of one block's best documents and some that aren't."""
    spark = index.sparkSession
    rows = queries.collect()       # a block, see Plan
    terms = {t: k for k, t in enumerate(dict.fromkeys(r["term"] for r in rows))}
    about = {r["term"]: r for r in rows}
    asked: dict[int | None, list[int]] = {}
    for r in rows:
        asked.setdefault(r["item_id"], []).append(terms[r["term"]])
    shared = spark.sparkContext.broadcast(_Block(
        list(asked), terms, np.array([about[t]["weight"] for t in terms], np.int64),
        np.array([about[t]["rare"] for t in terms], bool), [np.array(x, np.int64) for x in asked.values()],
        plan, documents, words))

    ours = queries.select("term").distinct().union(spark.createDataFrame([("",)], "term string"))
    listed = F.when(F.col("term") != "", F.struct("term", "at", "tf"))
    parts = index.join(ours, "term", "left_semi").groupBy("part").agg(
        F.max(F.when(F.col("term") == "", F.struct("ids", "lengths"))).alias("own"),
        F.collect_list(listed).alias("lists"))      # a segment's terms, bounded by its documents
    parts = parts.select("part", "own.ids", "own.lengths", "lists")

    def accumulate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                kept = [e for e in row["lists"] if not block.rare[block.terms[e["term"]]]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]], pa.int64()), pa.array([row["ids"]], pa.list_(pa.int64())),
                     pa.array([row["lengths"]], pa.binary()), pa.array([kept], _LIST),
                     pa.array([_accumulate(row, block)], _SUMS)],
                    names=["part", "ids", "lengths", "lists", "sums"])

    summed = stage(parts.mapInArrow(accumulate, SUMMED), "search-summed")
    best = summed.select(F.explode("sums").alias("s")).select("s.item", F.explode("s.best").alias("sum"))
    floors = {r["item"]: r["floor"] for r in _kth_floor(best, "item", "sum", plan.top).collect()}

    def rank(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        results = [_Results(floors.get(k, 0), plan.top) for k in range(len(block.items))]
        for batch in batches:
            for k in range(batch.num_rows):
                _rank(batch.slice(k, 1).to_pylist()[0], block, results)
        found = [(block.items[k], None if null else i, s) for k, r in enumerate(results)
                 for i, null, s in zip(r.ids.tolist(), r.nulls.tolist(), r.scores.tolist())]
        items, ids, scores = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (items, ids, scores)],
                                         names=["item_id", "doc_id", "score"])

    found = stage(summed.mapInArrow(rank, "item_id long, doc_id long, score long"), "search-found")
    shared.unpersist()
    return found


def search(docs: DataFrame, items: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """For each item of ``items`` (item_id, text) its ``plan.top`` best documents of ``docs``
    (doc_id, text), all with a score above 0 if fewer: item_id, rank (from 1), doc_id, score.

    Equal scores are ranked by doc_id, a null one last. A null text has no terms: such an item has
    no rows, such a document counts neither for N nor for L. Rows of ``docs`` with the same doc_id
    are documents of their own; rows of ``items`` with the same item_id, null too, are one item with
    the terms of all. Other columns are not read.

    Items are taken in blocks of some ``plan.block_terms`` terms (one item is never split): a block
    goes to every task, so its size, not that of the table, is what a task holds.
    """
    spark = small_batches(docs.sparkSession)
    asked = stage(item_terms(items), "search-terms")
    index = _index(docs, asked, plan)
    totals = index.where("term = ''").agg(F.sum("docs").alias("n"), F.sum("words").alias("l")).first()
    documents, words = totals["n"] or 0, totals["l"] or 0
    held = index.where("term <> ''").groupBy("term").agg(F.sum("docs").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1)))
    queries = stage(asked.join(held, "term").select(
        "item_id", "term", weight.cast("long").alias("weight"),
        (F.col("df") * plan.rare_share <= documents).alias("rare")), "search-queries")
    blocks = -(-queries.count() // plan.block_terms)
    block = F.pmod(F.xxhash64(F.coalesce("item_id", F.lit(0))), F.lit(max(blocks, 1)))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for k in range(blocks):
        found = found.union(_ranked_block(index, queries.where(block == k), plan, documents, words))
    floors = _kth_floor(found, "item_id", "score", plan.top).withColumnRenamed("item_id", "__item")
    near = found.join(floors, F.col("item_id").eqNullSafe(F.col("__item")), "left").where(
        "floor IS NULL OR score >= floor")
    place = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (near.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= plan.top)
            .select("item_id", "rank", "doc_id", "score"))
