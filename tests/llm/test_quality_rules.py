import random
import re

from pyspark.sql import functions as F

from cargolens.llm.quality_rules import (measures, quality_filter, quality_verdicts, sketches,
                                         thresholds)

from .helpers import DOCS, corpus


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, repeated = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            repeated |= {i + k for i in places for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(repeated), failed)


def test_counts_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " \n \t", "a b c d e", "a b c d e a b c d e", "a a a a a a", "é 𝄞x ü",
             "x y z", "one\n\none\n one\n", "w " * 30_000, " lead tail ", "a|b <c> $%&* #"]
    for _ in range(300):
        words = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 60))]
        texts.append("".join(w + rng.choice([" ", "\n", "\t ", "\x0b"]) for w in words))
    got = {r["doc_id"]: tuple(r)[1:7] for r in quality_verdicts(corpus(spark, texts)).collect()}
    assert got == {i: counts(t) for i, t in enumerate(texts)}


def test_junk_goes_and_clean_text_stays(spark):
    rng = random.Random(5)
    clean = [" ".join(rng.choice(["the", "words", "are", "plain", "here", "enough", f"n{rng.randrange(99)}"])
                      for _ in range(80)) for _ in range(900)]
    junk = [" ".join(w + "***" for w in text.split()) for text in clean[:40]]
    long_words = [" ".join("pneumono" * 3 + str(i) for i in range(30)) for _ in range(20)]
    docs = corpus(spark, clean + junk + long_words + [None, "too short"])
    kept = {r["doc_id"] for r in quality_filter(docs).collect()}
    verdicts = {r["doc_id"]: r for r in quality_verdicts(docs).collect()}
    assert kept == {i for i, r in verdicts.items() if r["kept"]}
    sound = {i for i in range(900) if not verdicts[i]["base_failed"]}
    assert len(sound - kept) <= 0.01 * len(sound)
    assert not kept & set(range(900, 962))
    assert quality_filter(docs).columns == docs.columns


def test_sketches_add_up_and_small_groups_take_the_language(spark):
    texts = [f"some plain words number {i} with enough of them to count {i % 7}" for i in range(420)]
    docs = corpus(spark, texts, source=lambda i: "tiny" if i < 10 else None)
    measured = measures(docs)
    whole = sketches(measured)
    parts = sketches(measured.where("doc_id % 2 = 0")).union(sketches(measured.where("doc_id % 2 = 1")))
    merged = parts.groupBy("lang", "source", "ratio", "bucket").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, merged.collect()), key=repr)
    fences = {(r["__lang"], r["__source"]): tuple(r)[2:] for r in thresholds(whole).collect()}
    assert fences["en", "tiny"] == tuple(
        thresholds(whole.withColumn("source", F.lit("one"))).where("__lang = 'en'").first())[2:]


def test_no_python_in_the_plans_and_no_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert quality_filter(empty).count() == 0 and quality_verdicts(empty).count() == 0
    for df in (measures(empty), quality_filter(empty), quality_verdicts(empty)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
