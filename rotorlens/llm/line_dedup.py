"""Line deduplication over all documents (native): explode normalised lines, hash, count documents, drop, reassemble.

Only hashes, ids and positions are shuffled to count; the texts are shuffled once, by document id, to be put together
again from the stretches between the positions that a document loses. A line that very many documents share is counted
on the map side first; in the join that finds its holders its rows are split by adaptive execution, as the other side
has one row per line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rotorlens.llm.common import SPACE_CHARS, ascii_lower, stored, text_of

MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: Column) -> Column:
    """Stripped of white space at both ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def _digest(key: Column) -> Column:
    """96 bits: 64 alone would meet by chance among the lines of a very large corpus."""
    return F.struct(F.xxhash64(key).alias("h"), F.crc32(key).alias("c"))


def shared_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """row_hash, doc_id, drop: per document that loses lines, their positions (from 1) in ascending order.

    Rows that repeat an id may have other texts, so positions belong to an id and a hash of the text.
    """
    # Two steps: next to the generator, the hash would be taken of the whole text again for every line.
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("row_hash"), F.split(text_of(text), "\n").alias("lines"))
    lines = whole.where(F.col("doc_id").isNotNull()).select("doc_id", "row_hash", F.posexplode("lines").alias("at", "line")).where(
        F.length("line") >= min_chars)
    keys = lines.select("doc_id", "row_hash", "at", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    # Distinct, as copies of a row hold the same places.
    holders = stored(keys.select("doc_id", "row_hash", "at", _digest(F.col("key")).alias("d")).select(
        "doc_id", "row_hash", "at", "d.h", "d.c").distinct(), "line-holders")
    # Stored, so that both sides of the join are shuffled for it: only then can adaptive execution split a hot line.
    common = stored(holders.groupBy("h", "c").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keeper")).where(
        F.col("n") >= min_docs).select("h", "c", "keeper"), "common-lines")
    losing = holders.join(common, ["h", "c"]).where(F.col("doc_id") < F.col("keeper"))
    return losing.groupBy("doc_id", "row_hash").agg(F.sort_array(F.collect_list(F.col("at") + 1)).alias("drop"))


def without(lines: Column, drop: Column) -> Column:
    """``lines`` without those at the ascending positions ``drop``, in time linear in the lines: a flag per line, made
    from the gaps between the positions, meets the line at its place."""
    before = lambda k: F.coalesce(F.get(drop, k - 1), F.lit(0))
    gap = lambda k: F.array_repeat(F.lit(True), F.get(drop, k) - before(k) - 1)
    gaps = F.transform(F.sequence(F.lit(0), F.size(drop) - 1), lambda k: F.concat(gap(k), F.array(F.lit(False))))
    flags = F.concat(F.flatten(gaps), F.array_repeat(F.lit(True), F.size(lines) - F.element_at(drop, -1)))
    marked = F.filter(F.arrays_zip(lines.alias("line"), flags.alias("stays")), lambda x: x["stays"])
    return F.transform(marked, lambda x: x["line"])


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS) -> DataFrame:
    """All columns of ``docs``, in the struct ``row`` (with the new text), and n_lines, n_dropped.

    A key of at least ``min_chars`` code points found in at least ``min_docs`` documents stays only in the document
    with the largest id that holds it (all its lines there). Null text: one empty line, and an empty text. Rows that
    repeat an id count as one document and each lose their lines. Rows with a null id keep all and count for nobody.
    Empty table: no rows. Extra columns may have any names.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("id"), F.xxhash64(text_of(text)).alias("hash"),
                       F.split(text_of(text), "\n").alias("lines"))
    drops = shared_lines(docs, doc_id, text, min_chars, min_docs).select(F.col("doc_id").alias("drop_id"), F.col("row_hash").alias("drop_hash"), "drop")
    # The lists of positions are the small side of every partition; the texts needn't be sorted to meet them.
    joined = rows.join(drops.hint("shuffle_hash"), (F.col("id") == F.col("drop_id")) & (F.col("hash") == F.col("drop_hash")), "left")
    kept = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(without(F.col("lines"), F.col("drop")))
    counted = joined.select("row", "lines", kept.alias("kept"))
    return counted.select(
        F.col("row").withField(f"`{text}`", F.array_join("kept", "\n")).alias("row"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"))


def deduped_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with its columns, the texts without the dropped lines."""
    return dedup_lines(docs, **options).select("row.*")
