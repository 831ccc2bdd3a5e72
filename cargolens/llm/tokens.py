"""Token ids of whole texts with a public vocabulary."""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cargolens.llm.common import SPACE, small_batches, text_bytes

VOCABULARY = "word_bpe_49k.json"
CHUNK_CACHE = 800_000  # encoded words a worker remembers
ENCODED_AT_ONCE = 1_000

# In texts of ASCII and Latin-1 alone no character composes with another, and their letters are
# letters in any version of Unicode.
BEYOND_LATIN = re.compile(rb"[\xC4-\xFF]").search
LETTER = r"[a-z\xDF-\xF6\xF8-\xFF]"
END_MARKS = re.compile(rf"(?<={LETTER})([!-/:-@\[-`{{-~]+)(?=[{SPACE}]|\Z)")
LETTERS = re.compile(f"{LETTER}+").fullmatch
BETWEEN = "0"          # a digit is a token of its own, which no word of letters holds


class _Chunks(dict):
    """Ids of a run without white space, as little-endian 32-bit numbers.

    The vocabulary's rules never join characters across white space, so a text's ids are those
    of its runs, one after the other; a run that comes again is not encoded again. The rules ignore
    case and part letters from marks, so words that differ in these are made one. What a batch
    has of new words is encoded together, a digit between them to tell their ids apart: a call
    for each takes twice the time.
    """

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer
        super().__init__()
        tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.encode = tokenizer.encode
        # These are found in texts as they are written, marks included.
        added = [token.content.lower() for token in tokenizer.get_added_tokens_decoder().values()]
        self.has_added = re.compile("|".join(map(re.escape, added)) or r"(?!)").search
        between = self.ids(BETWEEN)
        self.between = between[0]
        # Another vocabulary may have other rules.
        self.shares = len(between) == 1 and self.ids("\xC9t\xC9,; 0 a") == [
            i for part in ("\xE9t\xE9", ",;", "0", "a") for i in self.ids(part)]

    def ids(self, text: str) -> list[int]:
        return self.encode(text, add_special_tokens=False).ids

    def texts(self, texts: list[bytes]) -> Iterator[bytes]:
        """Ids of each text."""
        if len(self) > CHUNK_CACHE:
            self.clear()
        texts = [self.plain(text) for text in texts]
        new: set[bytes] = set()
        for text in texts:
            new.update(itertools.filterfalse(self.__contains__, text.split()))
        self.learn(new)
        for text in texts:
            yield b"".join(map(self.__getitem__, text.split()))

    def plain(self, text: bytes) -> bytes:
        """The text with its words in one spelling, if these are the same ids."""
        if not self.shares or BEYOND_LATIN(text):
            return text
        lowered = text.decode().lower()
        return text if self.has_added(lowered) else END_MARKS.sub(r" \1", lowered).encode()

    def learn(self, chunks: set[bytes]) -> None:
        words = []
        for chunk in chunks:
            text = chunk.decode()
            if self.shares and LETTERS(text):
                words.append(text)
            else:
                self[chunk] = _packed(self.ids(text))
        for k in range(0, len(words), ENCODED_AT_ONCE):
            some = words[k:k + ENCODED_AT_ONCE]
            ids = np.array(self.ids(f" {BETWEEN} ".join(some)), "<u4")
            ends = (4 * np.flatnonzero(ids == self.between)).tolist()
            packed = ids.tobytes()
            for word, start, end in zip(some, [0, *[end + 4 for end in ends]],
                                        [*ends, len(packed)], strict=True):
                self[word.encode()] = packed[start:end]


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


@functools.cache
def _chunks(vocabulary: str) -> _Chunks:
    """A worker's, which its tasks share."""
    return _Chunks(vocabulary)


def token_pieces(docs: DataFrame, capacity: int = 4096, end_id: int = 1,
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, start, length, ids): each text's ids and the end id, cut at ``capacity``.

    ``ids`` holds little-endian 32-bit numbers. A null text is empty and has the end id alone;
    rows may repeat, doc_id may be null, other columns are not read.
    """
    small_batches(docs.sparkSession)
    step, end = 4 * capacity, end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _chunks(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), chunks.texts(batch.column(1).to_pylist())):
                ids += end
                rows += [(doc_id, k // step, k // 4, ids[k:k + step])
                         for k in range(0, len(ids), step)]
            doc_ids, pieces, starts, ids = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(pieces, pa.int32()),
                 pa.array(starts, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array(ids, pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("long"), text_bytes("text")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids binary")
