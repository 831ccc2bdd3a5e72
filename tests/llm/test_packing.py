import bisect
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cargolens.llm.sum_of_squares import pack, pack_part, place
from cargolens.llm.tokens import VOCABULARY, _Chunks, token_pieces

from .helpers import DOCS, corpus

ODD = [None, "", " \n", "It's 3 o'clock", "ÉCOLE ﬁne Σίσυφος İx", "a b c é ́x",
       "<|endoftext|>x <|startoftext|> y", "emoji 👩‍👩‍👧 𝄞", "don't we'll\tI'D", "x" * 9000,
       "word " * 5000]


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def ids_of(row):
    return np.frombuffer(row["ids"], "<u4").tolist()


def best_fit_decreasing(lengths, capacity):
    gaps, count = [], 0
    for size in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, size)
        gap = gaps.pop(at) if at < len(gaps) else capacity
        count += gap == capacity
        bisect.insort(gaps, gap - size)
    return count


def test_ids_are_those_of_the_whole_text(spark, encode):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = [r["text"] for r in docs.collect()] + ODD
    rows = token_pieces(corpus(spark, texts).repartition(3), capacity=100).collect()
    whole = {}
    for row in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        ids = whole.setdefault(row["doc_id"], [])
        assert row["start"] == len(ids) and row["piece"] * 100 == row["start"]
        ids += ids_of(row)
        assert row["length"] == len(ids_of(row))
    assert whole == {i: encode(t) for i, t in enumerate(texts)}


def test_plain_words_are_encoded_once_and_together(spark, encode):
    rng = random.Random(5)
    letters = "abcxyzABCXYZéÉßÀñ"
    odd = "0123456789×÷ªſİǰ\u0301\u0327ﬁΣ»“’" + letters
    words = ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(1500)]
    marks = ["", "", ",", ".", "'s", "'", "...", "=\u0338", "),'ll", "-a", "0", "\xa0", "\x1c"]
    texts = [" ".join(rng.choice([w, w.upper(), w.lower(), w.title(), "'" + w]) + rng.choice(marks) if rng.random() < 0.8 or n % 2
                      else "".join(rng.choices(odd, k=rng.randint(1, 6))) for w in rng.choices(words, k=400))
             for n in range(40)]
    texts += [f"{t} {end}" for t, end in zip(texts, ["x<|endoftext|>", "<|startoftext|> y", "<|ENDOFTEXT|>", "=\u0338 J\u030c"])]
    got = list(_Chunks(VOCABULARY).texts([t.encode() for t in texts]))
    assert [[*np.frombuffer(ids, "<u4").tolist(), 1] for ids in got] == [encode(t) for t in texts]

    chunks, asked = _Chunks(VOCABULARY), []
    real = chunks.encode
    chunks.encode = lambda text, **how: (asked.append(text), real(text, **how))[1]
    plain = [f"{form}{mark}" for w in words for form in (w.upper(), w.lower()) for mark in ("", ",", ";")]
    list(chunks.texts([" ".join(plain[::2]).encode(), " ".join(plain[1::2]).encode()]))
    assert len(asked) < 10
    assert sum(text.count(" 0 ") + 1 for text in asked) <= len({x.lower() for w in words for x in (w.upper(), w)}) + 3


def test_sequences_are_gapless_and_within_capacity(spark):
    rng = random.Random(2)
    lengths = [rng.choice([1, 5, 40, 99, 100, rng.randint(1, 100)]) for _ in range(3000)]
    items = spark.createDataFrame([(i, n, None) for i, n in enumerate(lengths)],
                                  "doc_id LONG, length LONG, slot STRING")
    got = pack(items, capacity=100, part_items=700).collect()
    assert sorted((r["doc_id"], r["length"]) for r in got) == list(enumerate(lengths))
    used = {}
    for row in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert row["offset"] == used.get(row["sequence_id"], 0)
        used[row["sequence_id"]] = row["offset"] + row["length"]
    assert max(used.values()) <= 100
    assert len(used) <= 1.03 * best_fit_decreasing(lengths, 100)


def test_each_choice_has_the_least_sum_of_squares():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 21, 400)
    sequence, offset = place(lengths, np.arange(400), 20)
    gaps = {}
    for size, chosen, at in zip(lengths, sequence, offset):
        def cost(bin_):
            after = {**gaps, bin_: gaps.get(bin_, 20) - size}
            counts = np.bincount([g for g in after.values()], minlength=21)[1:]
            return int((counts ** 2).sum())
        choices = [b for b, g in gaps.items() if g >= size] + [len(gaps)]
        assert at == 20 - gaps.get(chosen, 20)
        assert cost(chosen) == min(map(cost, choices))
        gaps[int(chosen)] = gaps.get(int(chosen), 20) - size


def test_waste_is_small_on_many_items():
    rng = np.random.default_rng(1)
    lengths = np.minimum(4096, rng.lognormal(6.5, 1, 20_000).astype(int) + 1)
    sequence, _ = pack_part(lengths, 4096)
    assert sequence.max() + 1 <= 1.003 * lengths.sum() / 4096 + 1


def test_empty_and_equal_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert pack(token_pieces(empty)).count() == 0
    same = spark.createDataFrame([(None, "a b", None, None, 3, None)] * 50, DOCS)
    rows = pack(token_pieces(same), capacity=7).collect()
    assert len(rows) == 50 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 50


def test_query_digests(spark, encode):
    from cargolens.llm.queries import op3_sum_of_squares_packing
    rows = op3_sum_of_squares_packing(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = set()
    for d in docs:
        ids = encode(d["text"])
        for k in range(0, len(ids), 4096):
            piece = ids[k:k + 4096]
            want.add((d["doc_id"], k // 4096, k, len(piece),
                      zlib.crc32(np.array(piece, "<u4").tobytes())))
    assert len(rows) == len(want)
    assert {tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32"))
            for r in rows} == want
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= 1.02 * total / 4096 + 2
