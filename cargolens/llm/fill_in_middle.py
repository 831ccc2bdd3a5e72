"""Fill-in-the-middle texts, cut at line ends that come from a compressed set of boundaries.

Each text's line ends (code points) form a set of two levels in the manner of Roaring bitmaps:
the high bits of an offset choose a container, which holds the low 16 bits as a sorted array, a
bitmap or a list of runs, whatever is smallest. Containers carry the number of members before
them, so the k-th boundary is found by a search among containers and a select inside one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cargolens.llm.common import small_batches

LOW_BITS = 16
BITMAP_BYTES = (1 << LOW_BITS) // 8


@dataclass(frozen=True)
class Markers:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


@dataclass(frozen=True)
class Plan:
    """``share`` of the texts are transformed, ``spm_share`` of those begin with the suffix (in
    hundredths, by hash); ``seed`` is put before the document's id, then hashed."""

    seed: str = "7"
    share: int = 100
    spm_share: int = 50
    markers: Markers = Markers()


class ArrayContainer:
    kind = "array"

    def __init__(self, low: np.ndarray) -> None:
        self.low = low.astype(np.uint16)

    @staticmethod
    def size(low: np.ndarray) -> int:
        return 2 * len(low)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    kind = "bitmap"

    def __init__(self, low: np.ndarray) -> None:
        bits = np.zeros(1 << LOW_BITS, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.upto = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    @staticmethod
    def size(low: np.ndarray) -> int:
        return BITMAP_BYTES

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.upto, k, side="right"))
        left = int(self.words[word])
        for _ in range(k - (int(self.upto[word - 1]) if word else 0)):
            left &= left - 1                     # drop the lowest one
        return 64 * word + (left & -left).bit_length() - 1


class RunContainer:
    kind = "run"

    def __init__(self, low: np.ndarray) -> None:
        first = self._firsts(low)
        self.starts = low[first].astype(np.uint16)
        self.before = first                      # members before each run

    @staticmethod
    def _firsts(low: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.flatnonzero(np.diff(low) != 1) + 1])

    @classmethod
    def size(cls, low: np.ndarray) -> int:
        return 4 * len(cls._firsts(low))

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])


class BoundarySet:
    """A set of offsets that answers ``select(k)``: its k-th member, from 0."""

    def __init__(self, offsets: np.ndarray) -> None:
        """``offsets`` are distinct and ascending."""
        high = offsets >> LOW_BITS
        first = np.concatenate([[0], np.flatnonzero(np.diff(high)) + 1]) if len(high) else high
        self.before = first                      # members before each container
        self.high = high[first]
        self.containers = [self._smallest(part & ((1 << LOW_BITS) - 1))
                           for part in np.split(offsets, first[1:])] if len(high) else []
        self.cardinality = len(offsets)

    @staticmethod
    def _smallest(low: np.ndarray):
        kinds = (ArrayContainer, BitmapContainer, RunContainer)
        return min(kinds, key=lambda kind: kind.size(low))(low)

    def select(self, k: int) -> int:
        if not 0 <= k < self.cardinality:
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return (int(self.high[at]) << LOW_BITS) + self.containers[at].select(k - int(self.before[at]))


def line_boundaries(text: str) -> BoundarySet:
    """0 and the end of every line, an unfinished last one too, in code points."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(points == ord("\n")) + 1
    last = [len(points)] if len(points) and (not len(ends) or ends[-1] != len(points)) else []
    return BoundarySet(np.concatenate([[0], ends, last]).astype(np.int64))


def _transform(doc_id: int | None, text: str, plan: Plan) -> tuple:
    """(n, form, prefix_chars, middle_chars, output, containers) of one text."""
    ends = line_boundaries(text)
    n = ends.cardinality - 1
    kinds = ",".join(c.kind for c in ends.containers)
    seed = f"{plan.seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(seed.encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in range(0, 32, 8))
    m = plan.markers
    if not text or any(x in text for x in (m.prefix, m.suffix, m.middle)) or h3 % 100 >= plan.share:
        return n, "plain", None, None, text, kinds
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    start, end = ends.select(low), ends.select(high)
    prefix, middle, suffix = text[:start], text[start:end], text[end:]
    if h4 % 100 < plan.spm_share:
        form, output = "spm", m.suffix + suffix + m.prefix + prefix + m.middle + middle
    else:
        form, output = "psm", m.prefix + prefix + m.suffix + suffix + m.middle + middle
    return n, form, start, end - start, output, kinds


def fill_in_middle(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (lines), form (plain, psm, spm), prefix_chars,
    middle_chars (null if plain), output, containers (their kinds, in order).

    A null text is the empty one, which stays plain, as does a text that contains a marker. The
    cuts depend on the doc_id alone, so repeated rows give equal rows; a null doc_id is hashed as
    no digits. Rows need nothing of each other: no shuffle, and a lost task is run again with the
    same result. Whole texts, whatever their length; other columns are not read.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n", "form", "prefix_chars", "middle_chars", "output", "containers"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = [_transform(i, t, plan) for i, t in zip(ids, texts)]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                names=["doc_id", *names])

    source = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, "
                                  "middle_chars long, output string, containers string")


def restored(output: Column, form: Column, markers: Markers = Markers()) -> Column:
    """The text that ``output`` was made from. Each marker is in it exactly once: the text has none
    and none can arise where a text and a marker meet."""
    m = markers

    def parsed(order: tuple[str, str, str], text: str) -> Column:
        pattern = "".join(f"\\Q{marker}\\E(.*)" for marker in order)
        return F.regexp_replace(output, f"(?s)^{pattern}$", text)

    return (F.when(form == "psm", parsed((m.prefix, m.suffix, m.middle), "$1$3$2"))
            .when(form == "spm", parsed((m.suffix, m.prefix, m.middle), "$2$3$1")).otherwise(output))
