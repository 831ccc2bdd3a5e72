import duckdb
import pytest

import corpus_pipeline
from cargolens.llm.minhash import Plan
from cargolens.llm.mixing import targets
from cargolens.llm.queries import SQL
from cargolens.session import stage

from . import test_grace_dedup, test_minhash, test_packing
from .helpers import DOCS, corpus

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Documents, then what each stage made of the one before."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        out.append(stage(step(spark, out[-1], DATA), "test"))
    return out


def test_rules_keep_what_the_sql_keeps(stages):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = connection.execute(f"SELECT doc_id FROM ({SQL['op7_adaptive_quality']}) WHERE kept").fetchall()
    assert stages[1].columns == stages[0].columns
    assert sorted(r["doc_id"] for r in stages[1].collect()) == sorted(d for d, in want)


def test_copies_go(stages):
    rows = stages[1].collect()
    want = test_grace_dedup.expected([(r["doc_id"], r["text"]) for r in rows])
    assert {tuple(r) for r in stages[2].collect()} == {tuple(r) for r in rows if want[r["doc_id"]][2]}


def test_one_of_each_near_group_stays(stages):
    rows = sorted(stages[2].collect(), key=lambda r: r["doc_id"])
    want = test_minhash.expected([r["text"] for r in rows], Plan())
    assert {tuple(r) for r in stages[3].collect()} == {
        tuple(r) for r, (_, _, _, kept) in zip(rows, want) if kept}


def test_mix_takes_rows_up_to_three_times(stages):
    rows = stages[3].collect()
    mixed = [tuple(r) for r in stages[4].collect()]
    assert set(mixed) <= {tuple(r) for r in rows} and max(map(mixed.count, set(mixed))) <= 3
    words = lambda r: len((r["text"] or "").split())
    names = sorted({r["source"] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(words(r) for r in rows if r["source"] == s) for s in names]
    goals = targets(sizes, [1 + k % 3 for k in range(len(names))], 3)
    taken = {s: sum(words(r) for r in stages[4].collect() if r["source"] == s) for s in names}
    for s, goal in zip(names, goals):
        largest = max(words(r) for r in rows if r["source"] == s)
        assert abs(taken[s] - goal) <= max(largest / 2, goal / 1000)


def test_every_token_is_packed(stages):
    from tokenizers import Tokenizer
    import public_tokenizers
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((r["doc_id"], len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1)
                  for r in stages[4].collect())
    rows = stages[5].collect()
    assert sum(r["length"] for r in rows) == sum(n for _, n in want)
    assert sorted(r["doc_id"] for r in rows if r["piece"] == 0) == [d for d, _ in want]
    used = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert used.get(r["sequence_id"], 0) == r["offset"]
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values()) <= 4096
    assert len(used) <= test_packing.best_fit_decreasing([r["length"] for r in rows], 4096) * 1.03


def test_stages_bear_awkward_rows(spark):
    docs = corpus(spark, [None, "", " ", "word " * 30_000] + [f"plain text number {i} of a few words "
                  f"that are long enough to be kept {i * i} and {i ** 3}" for i in range(40)] * 2)
    for rows in (docs, spark.createDataFrame([], DOCS)):
        for name, step in corpus_pipeline.STAGES:
            rows = stage(step(spark, rows, DATA), "test")
            if name != "packing":
                assert rows.columns == docs.columns
