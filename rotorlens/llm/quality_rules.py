"""Quality rules whose limits follow the data (native).

Each document gets a few counts; each count becomes a rate per thousand words. Per language and source, a mergeable
quantile sketch of every rate gives the quartiles, and a document far above them is rejected. The sketch counts values
by their leading binary digits: sketches add up, so the aggregation combines on the map side, never holds a group and
gives the same answer in any order. Its relative error is below 2**-(DIGITS-1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rotorlens.llm.common import let, occurrences, small, stored, text_of, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
DIGITS = 7
#: A rate is too high above: upper quartile + FENCE * max(interquartile range, least spread of that rate). The least
#: spreads only keep a group without any spread from rejecting the first odd word or line; all else is the sketches'.
FENCE = 3
LEAST_SPREAD = {"symbol_rate": 10, "upper_rate": 50, "dup_line_rate": 20, "repeat_rate": 20, "length_rate": 300}


def repeated_words(tokens: Column, width: int = WINDOW) -> Column:
    """How many words of the array lie in a window of ``width`` words that occurs twice or more in it.

    Windows are compared by a 64-bit hash of their words' hashes. A text without a repeated window costs one hash set.
    """

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda s, k: F.when(k == F.size(starts) - 1, F.lit(width)).otherwise(
            F.least(F.lit(width), F.get(starts, k + 1) - s)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def of_sorted(pairs: Column) -> Column:
        again = F.filter(pairs, lambda p, k: (p["h"] == F.get(pairs, k - 1)["h"]) | (
            p["h"] == F.get(pairs, k + 1)["h"]))
        return let(F.sort_array(F.transform(again, lambda p: p["i"])), covered)

    def of_windows(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(pairs), of_sorted))

    def of_words(hashed: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashed) - width)
        return let(F.transform(starts, lambda i: F.xxhash64(*[F.get(hashed, i + j) for j in range(width)])),
                   of_windows)

    return F.when(F.size(tokens) < width, F.lit(0).cast("long")).otherwise(
        let(F.transform(tokens, lambda w: F.xxhash64(w)), of_words))


def document_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                    source: str = "source") -> DataFrame:
    """Counts of every document, one row per input row. A null text counts as empty, with no words."""
    body = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"),
                       text_of(text).alias("text"))
    listed = body.select("doc_id", "lang", "source", "text", words(F.col("text")).alias("tokens"),
                         F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    return listed.select(
        "doc_id", "lang", "source", F.size("tokens").cast("long").alias("n_words"),
        F.length(F.array_join("tokens", "")).cast("long").alias("word_chars"),
        occurrences(F.col("text"), r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("tokens")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        occurrences(F.col("text"), "[A-Z]").alias("n_upper"))


def _rates() -> dict[str, Column]:
    """Whole numbers per thousand words (lines for repeated lines)."""
    return {name: F.expr(f"1000 * {count} div greatest({of}, 1)") for name, count, of in (
        ("symbol_rate", "n_symbols", "n_words"), ("upper_rate", "n_upper", "n_words"),
        ("dup_line_rate", "n_dup_lines", "n_lines"), ("repeat_rate", "n_repeat_words", "n_words"),
        ("length_rate", "word_chars", "n_words"))}


def bucket(value: Column, digits: int = DIGITS) -> Column:
    """The value with all but its leading binary digits cleared."""
    drop = F.greatest(F.length(F.bin(value)) - digits, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketch(counts: DataFrame) -> DataFrame:
    """lang, source, rate, bucket, n: the sketch of every rate as counts per bucket. Sketches of parts add up."""
    rates = F.array(*[F.struct(F.lit(k).alias("rate"), bucket(v).alias("bucket")) for k, v in _rates().items()])
    return (counts.select("lang", "source", F.explode(rates).alias("r"))
            .groupBy("lang", "source", F.col("r.rate").alias("rate"), F.col("r.bucket").alias("bucket"))
            .agg(F.count("*").alias("n")))


def limits(sketched: DataFrame, fence: int = FENCE) -> DataFrame:
    """One row per language and source with the limit of every rate. A group's rows here are its buckets, some hundreds."""
    group = Window.partitionBy("lang", "source", "rate")
    ranked = sketched.select("*", F.sum("n").over(group.orderBy("bucket")).alias("upto"), F.sum("n").over(
        group).alias("total"))
    quartile = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bucket")))
    spread = F.create_map(*[F.lit(x) for pair in LEAST_SPREAD.items() for x in pair])
    fences = (ranked.groupBy("lang", "source", "rate").agg(quartile(1).alias("q1"), quartile(3).alias("q3"))
              .select("lang", "source", "rate", (F.col("q3") + fence * F.greatest(
                  F.col("q3") - F.col("q1"), spread[F.col("rate")].cast("long"))).alias("limit")))
    return fences.groupBy("lang", "source").pivot("rate", list(LEAST_SPREAD)).agg(F.min("limit"))


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                  source: str = "source", min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
                  fence: int = FENCE) -> DataFrame:
    """Counts, the base rule and the adaptive verdict, one row per input row.

    Null text: no words, so the base rule rejects it. Null language or source: a group of its own. Repeated rows are
    judged one by one. Empty table: no rows. Columns not named here are ignored.
    """
    counts = stored(document_counts(docs, doc_id, text, lang, source), "quality-counts")
    bounds = limits(sketch(counts), fence).select(
        F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), *LEAST_SPREAD)
    joined = counts.join(small(stored(bounds, "quality-limits", 1)), F.col("lang").eqNullSafe(F.col("g_lang")) & F.col(
        "source").eqNullSafe(F.col("g_source")), "left")
    base = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    too_high = F.lit(False)
    for name, rate in _rates().items():
        too_high = too_high | (rate > F.col(name))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base.alias("base_failed"), (~base & ~too_high).alias("kept"), "n_lines", "n_upper")
