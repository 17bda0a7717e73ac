"""One isolation forest per series (device, mode, axis)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rotorlens.functions.numeric import scrub
from rotorlens.operators.filters import SERIES, min_group_size
from rotorlens.operators.iforest import SUB_SAMPLE, TREES, Trees, grow_tree, unit_hash
from rotorlens.operators.quantiles import exact_quantiles
from rotorlens.session import busy_partitions, materialise

ROWS_PER_TASK = 50_000
#: Candidates per tree, in sub-samples; that fewer than one sub-sample of them is drawn does not happen in practice.
CANDIDATES = 3
_MODEL = ("trained int, centres array<double>, scales array<double>, sub_sample int, threshold double, roots array<int>, "
          "feature array<int>, split array<double>, left array<int>, right array<int>, path array<double>")


def _vector(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumn("_x", F.array(*[scrub(F.col(c).cast("double")) for c in columns]))


def _null_safe(df: DataFrame, by: Sequence[str], prefix: str) -> Column:
    match = F.lit(True)
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return match


def group_forest_fit(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = SERIES, contamination: float = 0.01,
    minimum: int = 50, trees: int = TREES, max_samples: int = SUB_SAMPLE, seed: int = 42, record_id: str = "record_id",
) -> DataFrame:
    """One model row per group with enough records: robust scaling, trees and threshold.

    Centres, scales and the threshold come from all rows of a group, by quantiles that gather no group. A tree grows on
    the ``max_samples`` rows of its group with the smallest hashes; a first draw per row and tree keeps a few times as
    many, so what is shuffled is bounded per group and tree, whatever the group's size.
    """
    by, columns = list(by), list(columns)
    rows = min_group_size(df, minimum, by).select(
        *by, F.col(record_id).alias("_id"), *[scrub(F.col(c).cast("double")).alias(f"_v{i}") for i, c in enumerate(columns)])
    rows = materialise(rows, "group-rows")
    values = [f"_v{i}" for i in range(len(columns))]
    quartiles = exact_quantiles(rows, values, [0.25, 0.5, 0.75], by).groupBy(*by, "column").agg(
        F.max("n").alias("n"), *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name) for p, name in (
            (0.25, "low"), (0.5, "centre"), (0.75, "high"))])
    place = F.substring("column", 3, 9).cast("int")
    width = F.when(F.col("high") > F.col("low"), F.col("high") - F.col("low")).otherwise(F.lit(1.0))
    scaling = quartiles.groupBy(*by).agg(
        F.max("n").cast("int").alias("trained"), F.sort_array(F.collect_list(F.struct(
            place.alias("i"), F.col("centre"), width.alias("scale")))).alias("_s"))
    scaling = materialise(scaling.select(
        *[F.col(c).alias(f"_g_{c}") for c in by], "trained", F.transform("_s", lambda x: x["centre"]).alias("centres"),
        F.transform("_s", lambda x: x["scale"]).alias("scales")), "group-scaling")

    x = F.zip_with(F.zip_with(F.array(*values), F.col("centres"), lambda v, c: v - c), F.col("scales"), lambda v, s: v / s)
    draw = unit_hash(F.lit(seed), F.col("tree"), F.col("_id"))
    drawn = (rows.join(scaling, _null_safe(rows, by, "_g_"))
             .select(*by, "_id", "trained", x.alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
             .withColumn("draw", draw).filter(F.col("draw") * F.col("trained") < CANDIDATES * max_samples))

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        chosen = group.sort_values(["draw", "_id"]).head(max_samples)
        grown = grow_tree(np.stack(chosen["_x"].to_numpy()), f"{seed}:{int(key[-1])}")
        return pd.DataFrame([[*key, *grown.values()]], columns=[*by, "tree", *grown])

    key_types = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)
    parts = busy_partitions(df.sparkSession)
    grown = drawn.drop("trained").repartition(parts, *by, "tree").groupBy(*by, "tree").applyInPandas(
        build, f"{key_types}, tree int, feature array<int>, split array<double>, left array<int>, right array<int>, path array<double>")

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        packed = Trees.pack(group.sort_values("tree")[["feature", "split", "left", "right", "path"]].to_dict("records"))
        return pd.DataFrame([[*key, packed.roots, packed.feature, packed.split, packed.left, packed.right, packed.path]],
                            columns=[*by, "roots", "feature", "split", "left", "right", "path"])

    packed = grown.groupBy(*by).applyInPandas(pack, f"{key_types}, {_MODEL.split('threshold double, ')[1]}")
    names = [part.split()[0] for part in _MODEL.split(", ")]
    untold = packed.join(scaling, _null_safe(packed, by, "_g_")).withColumns({
        "sub_sample": F.least("trained", F.lit(max_samples)), "threshold": F.lit(0.0)}).select(*by, *names)
    untold = materialise(untold, "group-trees")
    renamed = rows.select(*by, F.col("_id").alias(record_id), *[F.col(v).alias(c) for v, c in zip(values, columns)])
    scored = group_forest_predict(renamed, untold, columns, by, record_id).select(*by, "anomaly_score")
    limits = exact_quantiles(scored, "anomaly_score", [contamination], by).select(
        *[F.col(c).alias(f"_t_{c}") for c in by], F.col("quantile").alias("_limit"))
    return untold.join(limits, _null_safe(untold, by, "_t_")).withColumn("threshold", F.col("_limit")).select(*by, *names)


def group_forest_predict(
    df: DataFrame, models: DataFrame, columns: Sequence[str], by: Sequence[str] = SERIES,
    record_id: str = "record_id", rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``anomaly_score`` and ``is_anomaly`` per record; groups without a model get a null score and no anomaly.

    A large group is cut by id hash; its model row is repeated once per part, so every task holds one model and at
    most about ``rows_per_task`` records.
    """
    by = list(by)
    parts = df.groupBy(*by).agg(F.ceil(F.count("*") / F.lit(rows_per_task)).cast("int").alias("_parts"))
    slim = _vector(df, columns).select(*by, F.col(record_id).alias("_id"), "_x")
    right = parts.select(*[F.col(c).alias(f"_k_{c}") for c in by], "_parts")
    match = F.lit(True)
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    rows = slim.join(right, match).withColumn("_part", F.pmod(F.xxhash64("_id"), F.col("_parts")).cast("int")) \
        .select(*by, "_part", "_id", "_x")
    spread = models.join(right, match).drop(*[f"_k_{c}" for c in by]).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")

    def score(key: tuple, records: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"_id": records["_id"], "anomaly_score": np.nan, "is_anomaly": False})
        if len(model) and len(records):
            m = model.iloc[0]
            packed = Trees(*[np.asarray(m[c]) for c in ("roots", "feature", "split", "left", "right", "path")])
            x = (np.stack(records["_x"].to_numpy()) - np.asarray(m["centres"])) / np.asarray(m["scales"])
            out["anomaly_score"] = packed.score(x, int(m["sub_sample"]))
            out["is_anomaly"] = out["anomaly_score"] < m["threshold"]
        return out

    keys = [*by, "_part"]
    scored = rows.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(
        score, "_id string, anomaly_score double, is_anomaly boolean")
    scored = scored.withColumn("anomaly_score", F.nanvl("anomaly_score", F.lit(None).cast("double")))
    return df.join(scored.withColumnRenamed("_id", record_id), record_id)
