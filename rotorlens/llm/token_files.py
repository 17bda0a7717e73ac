"""Token ids as ORC files: run-length encoded integers, row indexes and a Bloom filter on the document ids.

Documents are dealt to files by ranges of ids and lie in ascending order in and across files, so stripes can be read in
parallel, and a search for an id or a range of ids skips files and stripes by their statistics.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rotorlens.llm.common import small, stored
from rotorlens.llm.tokens import END_ID, token_table

ROWS_PER_FILE = 20_000
STRIPE_BYTES = 16 << 20
INDEX_STRIDE = 1000


def id_ranges(docs: DataFrame, doc_id: str, rows_per_file: int = ROWS_PER_FILE) -> list[int]:
    """Upper bounds of the files' ids: quantiles of all ids, one per file."""
    ids = docs.select(F.col(doc_id).cast("long").alias("id"))
    files = max(1, -(-ids.count() // rows_per_file))
    if files == 1:
        return []
    cuts = ids.agg(F.percentile_approx("id", [k / files for k in range(1, files)], 10 * files).alias("c")).first().c
    return sorted(set(cuts or []))


def range_number(column: str, cuts: list[int]):
    """How many of the sorted bounds lie below the value; null ids come first, in range 0."""
    if not cuts:
        return F.lit(0)
    bounds = F.array(*[F.lit(c) for c in cuts])
    return F.coalesce(F.size(F.filter(bounds, lambda b: b < F.col(column))), F.lit(0))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 end_id: int = END_ID, rows_per_file: int = ROWS_PER_FILE, stripe_bytes: int = STRIPE_BYTES) -> None:
    """Write doc_id, ids, with the end id after each document, in ascending order of ids (nulls first, equal ids by
    text). Null and empty texts are the end id alone. An empty table writes files without rows."""
    count = max(1, docs.sparkSession.sparkContext.defaultParallelism, -(-docs.count() // rows_per_file))
    # The texts are dealt, not the ids: they are smaller, and drawing the ranges does not encode anything.
    dealt = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).repartitionByRange(
        count, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    (token_table(dealt, tokenizer, "doc_id", "text", end_id).write
     .option("orc.compress", "ZSTD").option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", INDEX_STRIDE)
     .option("orc.create.index", "true").option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .orc(path))


def read_tokens(spark: SparkSession, path: str, doc_id_type: str = "long") -> DataFrame:
    """doc_id, ids from the files; a filter on doc_id reaches stripe statistics and Bloom filters."""
    return spark.read.schema(f"doc_id {doc_id_type}, ids array<int>").orc(path)


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 of every row of token files."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            lengths = offsets[1:] - offsets[:-1]
            sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
                names=["doc_id", "n_tokens", "ids_crc32"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "ids").mapInArrow(of, f"doc_id {kind}, n_tokens long, ids_crc32 long")


def with_starts(counted: DataFrame, rows_per_range: int = ROWS_PER_FILE) -> DataFrame:
    """Adds ``start``: the sum of ``n_tokens`` over all rows before, by ascending doc_id (nulls first; equal ids by
    their length and digest; rows that repeat an id share one stretch, in whichever order the files hold them). Sums are
    taken per range of ids and then within each range."""
    held = stored(counted, "token-counts")
    ranged = held.select("*", range_number("doc_id", id_ranges(held, "doc_id", rows_per_range)).alias("range"))
    totals = ranged.groupBy("range").agg(F.sum("n_tokens").alias("sum"))
    # One row per range: a table of some thousandths of a millionth of the ids.
    before = totals.select(F.col("range"), (F.sum("sum").over(Window.orderBy("range")) - F.col("sum")).alias("before"))
    order = Window.partitionBy("range").orderBy(F.col("doc_id").asc_nulls_first(), "n_tokens", "ids_crc32").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    inside = ranged.select("*", (F.sum("n_tokens").over(order) - F.col("n_tokens")).alias("inside"))
    return inside.join(small(before), "range").select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
