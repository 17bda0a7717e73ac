"""Alert tables: labels, severities and the temporal filters on anomalies."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rotorlens.functions.labels import (
    alert_label,
    axis_label,
    event_time,
    fault_description,
    round_confidence,
    severity_by_confidence,
    translate_label,
)
from rotorlens.operators.filters import SERIES, anomalies
from rotorlens.operators.quantiles import quantile_columns
from rotorlens.operators.report import severity_by_crest
from rotorlens.operators.sampling import hash_key

ROWS_PER_BLOCK = 1_000_000


def label_predictions(predictions: DataFrame) -> DataFrame:
    """Add ``fault_label`` and ``severity_level`` by confidence to every prediction."""
    anomaly = F.coalesce("is_anomaly", F.lit(False))
    confidence = F.coalesce("confidence", F.lit(0.0))
    return predictions.withColumns({
        "is_anomaly": anomaly,
        "fault_label": fault_description(F.col("fault_type")),
        "confidence": round_confidence(confidence),
        "severity_level": severity_by_confidence(confidence, anomaly),
    })


def rederive_alerts(predictions: DataFrame) -> DataFrame:
    """Same for predictions read back from files: missing fields get defaults, unknown codes their own label."""
    anomaly = F.coalesce("is_anomaly", F.lit(False))
    confidence = F.coalesce("confidence", F.lit(0.0))
    code = F.coalesce("fault_type", F.lit(-1))
    return predictions.withColumns({
        "is_anomaly": anomaly,
        "fault_type": code,
        "fault_label": alert_label(code),
        "confidence": round_confidence(confidence),
        "severity_level": severity_by_confidence(confidence, anomaly),
    })


def report_frame(df: DataFrame) -> DataFrame:
    """Display columns for the report: UTC time, axis label, translated fault label."""
    out = df
    if "ts_ms" in df.columns:
        out = out.withColumn("timestamp", event_time(F.col("ts_ms")))
    if "fault_label" in df.columns:
        out = out.withColumn("fault_label", translate_label(F.col("fault_label")))
    return out.withColumn("axis_label", axis_label(F.col("axis")))


def report_alerts(df: DataFrame) -> DataFrame:
    """The anomalies of a report frame with severity by crest-factor quantiles in ``severity_crest``."""
    return severity_by_crest(anomalies(df))


# --- Temporal filters ---

def _time_blocks(df: DataFrame, rows_per_block: int) -> DataFrame:
    """``df`` (ts_ms, _fraction) with ``_block``, which never falls along (ts_ms, _fraction).

    Quantiles of all times cut the rows into blocks of about ``rows_per_block``. A time that fills several blocks is a
    quantile several times over; its rows are cut by the hash fraction. Only the quantiles reach the driver.
    """
    blocks = max(1, -(-df.count() // rows_per_block))
    if blocks == 1:
        return df.withColumn("_block", F.lit(0))
    probs = [i / blocks for i in range(1, blocks)]
    edges = df.agg(F.percentile_approx("ts_ms", probs, 10 * blocks).alias("e")).first()["e"]
    times = Counter(float(e) for e in edges or [])
    distinct = sorted(times)
    upto = list(accumulate((times[t] for t in distinct), initial=0))
    numbers = lambda values: F.array(*[F.lit(v) for v in values])
    placed = Bucketizer(splits=[float("-inf"), *distinct, float("inf")], inputCol="ts_ms", outputCol="_bucket",
                        handleInvalid="keep").transform(df)
    bucket = F.col("_bucket").cast("int")
    after = F.coalesce(F.get(numbers(upto), bucket), F.lit(upto[-1]))
    at_edge = F.col("ts_ms") == F.get(numbers(distinct), bucket - 1)
    here = F.get(numbers([times[t] for t in distinct]), bucket - 1)
    within = after - here + F.floor(F.col("_fraction") * (here + 1))
    return placed.withColumn("_block", F.when(at_edge, within).otherwise(after).cast("int")).drop("_bucket")


def persistence_by_rows(
    df: DataFrame, window: int = 5, minimum: int = 2, by: Sequence[str] = SERIES,
    rows_per_block: int = ROWS_PER_BLOCK, name: str = "persistent", seed: int = 42,
) -> DataFrame:
    """Keep an anomaly only if its series has ``minimum`` anomalies in the last ``window`` records.

    Equal times are ordered by id hash. A window over a whole series would put it in one task, and one series may
    hold most of the data (records without metadata all share one). So the time axis is cut into blocks of bounded
    size at the quantiles of all rows; each (series, block) is a window of its own, and the last ``window - 1`` flags
    of the blocks before it are carried over.
    """
    by = list(by)
    tie = hash_key("record_id", seed)
    fraction = F.floor(F.conv(F.substring(tie, 1, 3), 16, 10).cast("double") / 2) / F.lit(2048.0)
    marked = _time_blocks(df.withColumns({
        "_flag": F.coalesce("is_anomaly", F.lit(False)).cast("int"), "_tie": tie, "_fraction": fraction}), rows_per_block)
    order = [F.col("ts_ms"), F.col("_tie"), F.col("record_id")]
    within = W.partitionBy(*by, "_block").orderBy(*order)
    counted = marked.withColumns({
        "_row": F.row_number().over(within),
        "_own": F.sum("_flag").over(within.rowsBetween(-(window - 1), 0))})
    if window > 1:
        carried = _carried_flags(marked, by, order, window)
        match = F.col("_block") == F.col("_c_block")
        for c in by:
            match = match & F.col(c).eqNullSafe(F.col(f"_c_{c}"))
        # Only the first rows of a block look back; how many flags they need shrinks with the row number.
        missing = F.greatest(F.lit(window) - F.col("_row"), F.lit(0))
        size = F.size("_carry")
        taken = F.least(missing, size)
        tail = F.slice("_carry", size - taken + 1, taken)
        counted = counted.join(carried, match, "left").withColumn(
            "_own", F.col("_own") + F.when(F.col("_carry").isNotNull() & (missing > 0), F.aggregate(
                tail, F.lit(0), lambda acc, x: acc + x)).otherwise(F.lit(0)))
    keep = (F.col("_flag") == 1) & (F.col("_own") >= minimum)
    return counted.select(*df.columns, keep.alias(name))


def _carried_flags(marked: DataFrame, by: list[str], order: list[Column], window: int) -> DataFrame:
    """Per (series, block): the flags of the ``window - 1`` records before the block, oldest first."""
    keys = [*by, "_block"]
    last = W.partitionBy(*keys).orderBy(F.desc("ts_ms"), F.desc("_tie"), F.desc("record_id"))
    # row_number() <= k lets Spark keep only k rows per group before it shuffles.
    tails = (marked.select(*keys, "ts_ms", "_tie", "record_id", "_flag")
             .withColumn("_back", F.row_number().over(last)).filter(F.col("_back") <= window - 1)
             .groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("o"), "_flag"))).alias("_t")))
    # Every block listed holds at least one record, so window - 1 blocks back always reach far enough.
    before = W.partitionBy(*by).orderBy("_block").rowsBetween(-(window - 1), -1)
    flags = tails.select(*keys, F.transform("_t", lambda x: x["_flag"]).alias("_t"))
    joined = flags.select(*keys, F.flatten(F.collect_list("_t").over(before)).alias("_all"))
    size = F.size("_all")
    taken = F.least(size, F.lit(window - 1))
    return joined.select(*[F.col(c).alias(f"_c_{c}") for c in by], F.col("_block").alias("_c_block"),
                         F.slice("_all", size - taken + 1, taken).alias("_carry"))


def persistence_by_time(
    df: DataFrame, range_ms: int, minimum: int = 2, by: Sequence[str] = SERIES, name: str = "persistent",
) -> DataFrame:
    """Keep an anomaly only if its series has ``minimum`` anomalies within the last ``range_ms`` (both ends included).

    Anomalies are counted per series and millisecond first (map-side combine), which folds any pile of records with
    one time into a row. The window then runs per stretch of ``range_ms``; the rows of a stretch also enter the next
    one, as history only.
    """
    by = list(by)
    hits = (anomalies(df).groupBy(*by, "ts_ms").agg(F.count("*").alias("_hits")))
    stretch = F.floor(F.col("ts_ms") / F.lit(float(max(range_ms, 1))))
    both = hits.withColumn("_stretch", F.explode(F.array(stretch, stretch + 1))) \
        .withColumn("_home", stretch == F.col("_stretch"))
    recent = W.partitionBy(*by, "_stretch").orderBy("ts_ms").rangeBetween(-range_ms, 0)
    counted = both.withColumn("_recent", F.sum("_hits").over(recent)).filter("_home AND _recent >= %d" % minimum)
    right = counted.select(*[F.col(c).alias(f"_p_{c}") for c in by], F.col("ts_ms").alias("_p_ts"),
                           F.lit(True).alias("_persistent"))
    match = F.col("ts_ms") == F.col("_p_ts")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_p_{c}"))
    joined = df.join(right, match, "left")
    keep = F.coalesce("is_anomaly", F.lit(False)) & F.coalesce("_persistent", F.lit(False))
    return joined.select(*df.columns, keep.alias(name))


def extreme_scores(
    df: DataFrame, quantile: float = 0.01, by: Sequence[str] = SERIES, score: str = "anomaly_score",
    name: str = "extreme",
) -> DataFrame:
    """Flag records scored below the given quantile of their group."""
    by = list(by)
    limits = quantile_columns(df, score, {"_limit": quantile}, by)
    right = limits.select(*[F.col(c).alias(f"_q_{c}") for c in by], "_limit")
    match = F.lit(True)
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_q_{c}"))
    joined = df.join(right, match, "left")
    return joined.select(*df.columns, F.coalesce(F.col(score) < F.col("_limit"), F.lit(False)).alias(name))


def combined_flag(df: DataFrame, name: str = "confirmed") -> DataFrame:
    """Persistent or extreme."""
    return df.withColumn(name, F.col("persistent") | F.col("extreme"))


def chronological(df: DataFrame, by: Sequence[str] = SERIES, time_column: str = "ts_ms") -> DataFrame:
    """Rows in series and time order inside range partitions: sorted files without one global task."""
    return df.repartitionByRange(*by, time_column, "record_id").sortWithinPartitions(*by, time_column, "record_id")
