import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargolens.llm.fill_in_middle import (BoundarySet, Markers, Plan, fill_in_middle, line_boundaries,
                                          restored)
from tests.llm.helpers import corpus

RNG = random.Random(13)
TEXTS = [None, "", "\n", "a", "a\n", "\n\n\n", "a\nb\nc", "é𝄞\nü\n\n中文\n", "x <P> y\nz", "<S>", "a<M>b",
         "<\nP>\n<S\n>\n<", "a\r\nb\rc", "same\ntext\n", "same\ntext\n", "\n" * 70_000,
         "line of words\n" * 20_000, "".join(RNG.choices("ab\n", k=200_000)),
         "𝄞" * 70_000 + "\n" + "é" * 70_000 + "\nend"]


def plain(doc_id, text):
    """The contract, said plainly."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[k:k + 8], 16) for k in range(0, 32, 8))
    n = len(units)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    out = (f"<S>{suffix}<P>{prefix}<M>{middle}" if h4 % 100 < 50 else f"<P>{prefix}<S>{suffix}<M>{middle}")
    return n, "spm" if h4 % 100 < 50 else "psm", len(prefix), len(middle), out


@pytest.mark.parametrize("offsets, kinds", [
    ([], []), ([0], ["array"]), ([5, 65_535, 65_536, 200_000], ["array", "array", "array"]),
    (list(range(70_000)), ["run", "run"]), (list(range(0, 131_072, 3)), ["bitmap", "bitmap"]),
    (list(range(10)) + list(range(65_536, 65_546)) + [10**9], ["run", "run", "array"])])
def test_select_and_containers(offsets, kinds):
    found = BoundarySet(np.array(offsets, np.int64))
    assert [c.kind for c in found.containers] == kinds
    assert [found.select(k) for k in range(len(offsets))] == offsets
    for k in (-1, len(offsets)):
        with pytest.raises(IndexError):
            found.select(k)


def test_select_on_random_sets():
    rng = np.random.default_rng(4)
    for density in (0.001, 0.05, 0.3, 0.9, 0.999):
        offsets = np.flatnonzero(rng.random(150_000) < density)
        found = BoundarySet(offsets)
        for k in rng.integers(len(offsets), size=300):
            assert found.select(int(k)) == offsets[k]


def test_boundaries_are_those_of_the_lines():
    for text in TEXTS:
        found = line_boundaries(text or "")
        ends = [0]
        for unit in re.findall(r"[^\n]*\n|[^\n]+", text or ""):
            ends.append(ends[-1] + len(unit))
        assert [found.select(k) for k in range(0, len(ends), 1 + len(ends) // 500)] == \
            ends[::1 + len(ends) // 500]


def test_rows_are_those_of_the_contract(spark):
    docs = corpus(spark, TEXTS * 3).repartition(4)
    rows = fill_in_middle(docs).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert len(rows) == 3 * len(TEXTS)
    for r in rows:
        text = TEXTS[r["doc_id"] % len(TEXTS)]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain(r["doc_id"], text)
        assert r["back"] == (text or "")
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}


def test_shares_seed_and_markers(spark):
    docs = corpus(spark, [f"a\nb{i}\nc <P>" for i in range(400)])
    markers = Markers("[p]", "[s]", "[m]")
    rows = fill_in_middle(docs, Plan("other", 30, 10, markers)).withColumn(
        "back", restored(F.col("output"), F.col("form"), markers)).collect()
    forms = [r["form"] for r in rows]
    assert 230 < forms.count("plain") < 330 and 1 <= forms.count("spm") < 30
    assert all(r["back"] == f"a\nb{r['doc_id']}\nc <P>" for r in rows)


def test_empty_table_null_ids_and_repeated_rows(spark):
    assert fill_in_middle(corpus(spark, [])).count() == 0
    schema = "doc_id LONG, text STRING, n STRING, output STRING"
    rows = fill_in_middle(spark.createDataFrame([(None, "a\nb", "x", "y")] * 2 + [(None, None, None, None)],
                                                schema)).collect()
    assert rows.count(rows[0]) == 2 and len(rows) == 3
    assert rows[0]["n"] == 2 and rows[2]["form"] == "plain"
