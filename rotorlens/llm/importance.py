"""Importance resampling towards a target distribution, by hashed n-gram features.

Every document's n-grams fall into hash buckets. The gain of a bucket is the logarithm of its share in the target texts
over its share in the corpus, and a document's weight is the sum of the gains of all its n-grams. Documents are drawn
without replacement by weight plus Gumbel noise that follows from the id alone.

The n-grams of a slice of texts are interned in an open-addressed table (``hashing.intern``: XXH64 digests, compared
byte by byte): each distinct one has a slot with its bucket and its count, and each occurrence the number of its slot.
The counts give the corpus totals; the occurrences' buckets are kept with the document, so the gains, known once all is
counted, are gathered from them without reading any text again.

Null and empty texts have no features and weight 0. Rows that repeat an id are documents of their own; where score and
id are equal they are ranked in an order that stays the same once the table of features is written. Null ids have the
same noise, that of the empty id, and come after other ids in ties. Extra columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rotorlens.llm.common import parts_for, small, stored
from rotorlens.llm.hashing import intern, runs_of, word_table, words_of
from rotorlens.llm.tokens import slices

#: Bytes that part words: ASCII without letters and digits.
BREAKS = ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LONGEST = 1
BUCKETS = 10_000
LEAST_WORDS = 20
SHARE = (10, 100)
SEED = 2024
#: Characters of text whose n-grams are interned together.
SLICE = 1 << 20


def featurise(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, doc_id: str = "doc_id", text: str = "text"
              ) -> DataFrame:
    """doc_id, n_words, n_features, occurrences (the buckets of all n-grams, 32-bit numbers), totals: one row per
    document, and per task one row with totals (n-grams by bucket) alone. Stored."""
    table = word_table(BREAKS)
    kind = docs.schema[doc_id].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, ids = np.zeros(buckets, np.int64), None
        for batch in batches:
            ids = batch.column(0)
            for a, b in slices(batch.column(1), SLICE):
                words, n_words = words_of(batch.column(1).slice(a, b - a).to_pylist(), table)
                grams, n_grams = runs_of(words, n_words, longest)
                slot_of, sample = intern(grams)
                slot_count = np.bincount(slot_of, minlength=len(sample))
                slot_bucket = np.fromiter((zlib.crc32(grams.bytes_of(k)) % buckets for k in sample.tolist()), np.uint32, len(sample))
                totals += np.bincount(slot_bucket, slot_count, buckets).astype(np.int64)
                held = pa.array(np.concatenate(([0], np.cumsum(4 * n_grams))).astype(np.int32))
                found = pa.BinaryArray.from_buffers(pa.binary(), b - a, [None, held.buffers()[1], pa.py_buffer(slot_bucket[slot_of].tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(n_words), pa.array(n_grams), found, pa.nulls(b - a, pa.list_(pa.int64()))],
                    names=["doc_id", "n_words", "n_features", "occurrences", "totals"])
        if ids is None:
            return
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, ids.type), *[pa.nulls(1, pa.int64())] * 2, pa.nulls(1, pa.binary()), pa.array([totals], pa.list_(pa.int64()))],
            names=["doc_id", "n_words", "n_features", "occurrences", "totals"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return stored(rows.mapInArrow(describe, f"doc_id {kind}, n_words long, n_features long, occurrences binary, totals array<long>"),
                  "n-grams", files=1 << 20)


def bucket_totals(featured: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """n-grams by bucket: one number per bucket comes to the driver, however many documents there are."""
    sums = (featured.where("totals is not null").select(F.posexplode("totals").alias("bucket", "n"))
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    totals = np.zeros(buckets, np.int64)
    for row in sums:
        totals[row.bucket] = row.n
    return totals


def bucket_gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / corpus share)) of each bucket, shares smoothed by 1 n-gram a bucket."""
    t, s, k = target.astype(float), corpus.astype(float), len(corpus)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def weigh(featured: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document: the gains of all its n-grams' buckets, summed."""
    shared = featured.sparkSession.sparkContext.broadcast(gains.tobytes())  # one number per bucket
    kind = featured.schema["doc_id"].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.frombuffer(shared.value, np.int64)
        for batch in batches:
            sizes = batch.column(2).to_numpy(zero_copy_only=False)
            values = gain[np.frombuffer(b"".join(x.as_buffer() for x in batch.column(3)), np.uint32)]
            upto = np.concatenate(([0], np.cumsum(values)))
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(upto[ends] - upto[ends - sizes])], names=["doc_id", "n_words", "n_features", "weight"])

    rows = featured.where("totals is null").select("doc_id", "n_words", "n_features", "occurrences")
    return rows.mapInArrow(gather, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the SHA-256 of ``seed:id``."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def ranked(scored: DataFrame, drawn: int) -> DataFrame:
    """``scored`` with its rank by descending score, then id; null beyond the first ``drawn``.

    The rows, which are narrow, are range-partitioned by that order, with a row number as the last key, so that equal
    rows are dealt too. Each task numbers its rows, and the counts of the tasks before are added.
    """
    spark = scored.sparkSession
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    dealt = scored.repartitionByRange(parts_for(scored), *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in dealt.schema)}, _at long"

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = 0
        for batch in batches:
            yield batch.assign(_at=np.arange(at + 1, at + 1 + len(batch)))
            at += len(batch)

    numbered = stored(dealt.mapInPandas(number, schema), "numbered", files=1 << 20)
    counts = sorted(numbered.groupBy("_part").agg(F.max("_at").alias("n")).collect())  # one row per partition
    before = np.concatenate(([0], np.cumsum([n for _, n in counts]))).tolist()
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "_part int, _before long")
    place = F.col("_at") + F.col("_before")
    return numbered.join(small(offsets), "_part").withColumn("rank", F.when(place <= drawn, place)).drop("_part", "_at", "_before")


def resample(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
             share: tuple[int, int] = SHARE, seed: int = SEED, doc_id: str = "doc_id", text: str = "text",
             target_id: str = "item_id", target_text: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank (null: not drawn) of every document.

    Of the N documents with at least ``least_words`` words, floor(share * N) are drawn. An empty corpus gives no rows;
    with an empty target, gains are relative to equal shares.
    """
    featured = featurise(docs, longest, buckets, doc_id, text)
    aims = featurise(target, longest, buckets, target_id, target_text)
    gains = bucket_gains(bucket_totals(aims, buckets), bucket_totals(featured, buckets))
    scored = stored(weigh(featured, gains).withColumns({
        "score": F.col("weight") + noise(F.col("doc_id"), seed), "_row": F.monotonically_increasing_id()}), "scored")
    eligible = F.col("n_words") >= least_words
    drawn = share[0] * scored.where(eligible).count() // share[1]
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    rest = scored.where(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return ranked(scored.where(eligible), drawn).select(*columns).unionByName(rest.select(*columns))


def resampled_documents(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that are drawn; rows that repeat an id stay or go together: they stay if one is drawn."""
    chosen = resample(docs, target, doc_id=doc_id, **options).where("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    rows = docs.select(F.struct("*").alias("_row"), F.col(doc_id).alias("_id"))
    return rows.join(chosen, rows["_id"].eqNullSafe(chosen["_drawn"]), "left_semi").select("_row.*")
