"""Seeded, reproducible samples and ranks that depend on the record id alone.

A hash of the id gives every row a place in a random order that no repartitioning changes. Ranks within a group are
computed per hash block and shifted by the counts of the blocks before, so even a group holding most rows is ranked
by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HASH_BLOCK_DIGITS = 3  # 16 ** 3 blocks per group


def hash_key(record_id: Column | str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(record_id) if isinstance(record_id, str) else record_id))


def hash_sample(df: DataFrame, n: int, record_id: str = "record_id", seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, as a distributed top-n (no full sort)."""
    return df.orderBy(hash_key(record_id, seed), record_id).limit(n)


def first_records(df: DataFrame, n: int, record_id: str = "record_id") -> DataFrame:
    return df.orderBy(record_id).limit(n)


def hash_rank(
    df: DataFrame, by: Sequence[str], record_id: str = "record_id", seed: int = 42, name: str = "hash_rank",
    digits: int = HASH_BLOCK_DIGITS, below: int | None = None,
) -> DataFrame:
    """1-based rank within ``by`` in hash order.

    ``below`` keeps ranks up to that number only; whole blocks beyond it are dropped before anything is sorted.
    """
    by = list(by)
    keyed = df.withColumn("_key", hash_key(record_id, seed)).withColumn("_block", F.substring("_key", 1, digits))
    counts = keyed.groupBy(*by, "_block").agg(F.count("*").alias("_rows"))
    # One row per (group, block), so this window sorts at most 16 ** digits rows per group.
    before = W.partitionBy(*by).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*by, "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    if below is not None:
        offsets = offsets.filter(F.col("_offset") < below)
    keys = [*by, "_block"]
    renamed = offsets.select(*[F.col(k).alias(f"_o_{i}") for i, k in enumerate(keys)], "_offset")
    condition = F.lit(True)
    for i, k in enumerate(keys):
        condition = condition & keyed[k].eqNullSafe(renamed[f"_o_{i}"])
    joined = keyed.join(renamed, condition, "inner")
    within = W.partitionBy(*keys).orderBy("_key", record_id)
    ranked = joined.withColumn(name, (F.row_number().over(within) + F.col("_offset")).cast("long"))
    if below is not None:
        ranked = ranked.filter(F.col(name) <= below)
    return ranked.select(*df.columns, name)


def group_sample_cap(
    df: DataFrame, by: Sequence[str], cap: int = 10000, record_id: str = "record_id", seed: int = 42,
) -> DataFrame:
    """At most ``cap`` training rows per group, chosen in hash order (a sampling operator by definition)."""
    return hash_rank(df, by, record_id, seed, "_rank", below=cap).drop("_rank")


def number_copies(df: DataFrame, record_id: str = "record_id", chunk: int = 100_000) -> DataFrame:
    """Give copies of one record distinct ids: the first keeps its id, the others get ``id#2``, ``id#3``, ...

    The id is a hash of the whole line, so rows with equal id are equal in every column. They are counted (map-side
    combined), then re-created in chunks of bounded size, so no task ever holds or emits all copies of one record.
    """
    columns = [c for c in df.columns if c != record_id]
    counted = df.groupBy(record_id).agg(*[F.first(c).alias(c) for c in columns], F.count("*").alias("_copies"))
    chunks = counted.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), ((F.col("_copies") - 1) / F.lit(chunk)).cast("long"))))
    single = chunks.filter(F.col("_copies") <= chunk)
    many = chunks.filter(F.col("_copies") > chunk).repartition(record_id, "_chunk")
    spread = single.unionByName(many)
    first = F.col("_chunk") * chunk + 1
    last = F.least(F.col("_copies"), (F.col("_chunk") + 1) * chunk)
    numbered = spread.withColumn("_copy", F.explode(F.sequence(first, last)))
    new_id = F.when(F.col("_copy") == 1, F.col(record_id)).otherwise(
        F.concat(F.col(record_id), F.lit("#"), F.col("_copy").cast("string")))
    return numbered.withColumn(record_id, new_id).select(*df.columns)
