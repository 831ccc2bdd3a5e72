"""Quality rules whose thresholds follow each language and source.

Fixed rules reject texts that are too short or repeat themselves. For the rest, each of four
ratios is summed up per language and source in a mergeable quantile sketch: a histogram with
buckets of 8 significant bits, so a quantile is off by less than 1/128 of its value, sketches
add up by bucket, and the order of adding makes no difference. A document is rejected when a
ratio lies further outside the quartiles of its group than ``FENCE`` times their distance. The
thresholds are joined to the documents.

Only built-in functions: words, lines and windows of a text are handled inside its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cargolens.llm.common import SPACE, words
from cargolens.session import stage

WINDOW = 5
MIN_WORDS, MOST_REPEATED = 10, 20   # words; per cent of the words
FENCE = 3
GROUP_ROWS = 100   # a group of fewer documents takes its language's sketch, then the whole one
# Ratio, its scale, and the least distance of the quartiles that counts: most texts have no
# symbol, equal line or repeated window at all, and a single one must not reject the next.
RATIOS = {"chars_a_word": (1000, 100), "symbols_a_char": (10_000, 100),
          "equal_lines": (10_000, 1500), "repeated_words": (10_000, 500)}


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))


def _covered(places: Column) -> Column:
    """Words covered by windows at the sorted ``places``."""
    ends = F.transform(places, lambda at, i: F.least(
        F.lit(WINDOW), F.coalesce(F.get(places, i + 1), at + WINDOW) - at))
    return F.aggregate(ends, F.lit(0), lambda total, x: total + x)


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of the base rules, prefixed with two underscores.

    A window of five words is compared by a hash of 64 bits of its words' hashes. A text in which
    no hash comes twice, as most, ends there; else the hashes are sorted with their places.
    """
    text = F.coalesce("text", F.lit(""))
    df = docs.withColumns({"__w": words(F.col("text")), "__lines": _lines(text)})
    df = df.withColumns({
        "__n_words": F.size("__w").cast("long"),
        "__word_chars": F.char_length(F.array_join("__w", "")).cast("long"),
        "__n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "__n_lines": F.size("__lines").cast("long"),
        "__n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__h": F.transform("__w", lambda w: F.xxhash64(w))}).drop("__w", "__lines")
    starts = F.when(F.size("__h") >= WINDOW, F.sequence(F.lit(0), F.size("__h") - WINDOW))
    df = df.withColumn("__hashes", F.transform(starts, lambda i: F.xxhash64(
        *[F.get("__h", i + k) for k in range(WINDOW)]))).drop("__h")
    twice = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    df = df.withColumn("__sorted", F.when(twice, F.array_sort(F.transform(
        "__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("__hashes")
    near = F.col("__sorted")
    df = df.withColumn("__places", F.array_sort(F.transform(F.filter(near, lambda x, i: (
        F.coalesce(F.get(near, i + 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(near, i - 1)["h"] == x["h"], F.lit(False)))), lambda x: x["i"])))
    df = df.drop("__sorted").withColumn(
        "__n_repeat_words", F.coalesce(_covered(F.col("__places")), F.lit(0)).cast("long"))
    return df.drop("__places").withColumn(
        "__base_failed", (F.col("__n_words") < MIN_WORDS)
        | (100 * F.col("__n_repeat_words") > MOST_REPEATED * F.col("__n_words")))


def _ratio(name: str) -> Column:
    """A ratio as a whole number; only where the base rules hold, so nothing divides by 0."""
    over, under = {"chars_a_word": ("__word_chars", "__n_words"),
                   "symbols_a_char": ("__n_symbols", "__word_chars"),
                   "equal_lines": ("__n_dup_lines", "__n_lines"),
                   "repeated_words": ("__n_repeat_words", "__n_words")}[name]
    return F.when(~F.col("__base_failed"), F.expr(f"{RATIOS[name][0]} * {over} div {under}"))


def _bucket(value: Column) -> Column:
    """The value with its 8 highest bits kept."""
    bits = F.greatest(F.lit(0), F.length(F.bin(value)) - 8)
    return F.call_function("shiftleft", F.call_function("shiftright", value, bits), bits)


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, ratio, bucket, n), at most a few hundred buckets for each ratio and group."""
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), _bucket(_ratio(r)).alias("bucket"))
                                 for k, r in enumerate(RATIOS)])).alias("v")
    return (measured.where(~F.col("__base_failed")).select("lang", "source", values)
            .groupBy("lang", "source", "v.ratio", "v.bucket").agg(F.count("*").alias("n")))


def _fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each group: its documents, and low and high fence of each ratio."""
    merged = sketch.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "ratio")
    ranked = merged.withColumns({
        "upto": F.sum("n").over(group.orderBy("bucket")), "all": F.sum("n").over(group)})
    quartiles = ranked.groupBy(*keys, "ratio").agg(
        F.max("all").alias("rows"),
        F.min(F.when(4 * F.col("upto") >= F.col("all"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("all"), F.col("bucket"))).alias("q3"))
    least = F.element_at(F.array(*[F.lit(f) for _, f in RATIOS.values()]), F.col("ratio") + 1)
    reach = FENCE * F.greatest(F.col("q3") - F.col("q1"), least)
    fenced = quartiles.withColumns({"low": F.col("q1") - reach, "high": F.col("q3") + reach})
    return fenced.groupBy(*keys).agg(F.max("rows").alias("rows"), *[
        F.max(F.when(F.col("ratio") == k, F.struct("low", "high"))).alias(r)
        for k, r in enumerate(RATIOS)])


def thresholds(sketch: DataFrame) -> DataFrame:
    """Fences for each (lang, source). The sketches of small groups are too rough, so those take
    the merged sketch of their language, or of everything."""
    own = _fences(sketch, ["lang", "source"])
    by_lang = _fences(sketch, ["lang"]).select(
        F.col("lang").alias("__lang"), F.struct("*").alias("by_lang"))
    whole = _fences(sketch.withColumn("all", F.lit(1)), ["all"]).first()  # one row of numbers

    def of_all(ratio: str) -> Column:
        fence = whole[ratio] if whole else {"low": None, "high": None}
        return F.struct(*[F.lit(fence[k]).cast("long").alias(k) for k in ("low", "high")])

    return own.join(by_lang, F.col("lang").eqNullSafe(F.col("__lang")), "left").select(
        F.col("lang").alias("__lang"), F.col("source").alias("__source"),
        *[F.when(F.col("rows") >= GROUP_ROWS, F.col(r))
          .when(F.col("by_lang.rows") >= GROUP_ROWS, F.col(f"by_lang.{r}"))
          .otherwise(of_all(r)).alias(f"__{r}_fence") for r in RATIOS])


def judged(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with the counts and ``__kept``. They are stored with the counts, which
    are then read for the sketches and for the verdict. A null lang or source is a group like any
    other; a null text has no words and fails. Equal rows are judged alike."""
    counts = measures(docs)
    measured = stage(counts.select(*columns, *[c for c in counts.columns if c not in docs.columns]),
                     "quality-measures")
    fences = stage(thresholds(stage(sketches(measured), "quality-sketches")), "quality-thresholds")
    inside = F.lit(True)
    for ratio in RATIOS:
        fence = F.col(f"__{ratio}_fence")
        inside = inside & _ratio(ratio).between(fence["low"], fence["high"])
    return (measured.join(fences, F.col("lang").eqNullSafe(F.col("__lang"))
                          & F.col("source").eqNullSafe(F.col("__source")), "left")
            .withColumn("__kept", ~F.col("__base_failed") & F.coalesce(inside, F.lit(True))))


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept, one row per row of ``docs``."""
    found = judged(docs.select("doc_id", "lang", "source", "text"), ["doc_id", "lang", "source"])
    return found.select("doc_id", *[F.col(f"__{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are."""
    return judged(docs, docs.columns).where("__kept").select(*docs.columns)
