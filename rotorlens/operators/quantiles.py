"""Exact quantiles with linear interpolation that never gather a group in one task.

``F.percentile`` keeps every distinct value of a group in one aggregation buffer. Here a sketch
(``percentile_approx``, merged map-side) gives for each quantile a bracket that is certain to hold the wanted order
statistic; a second pass counts the values between brackets and, by distinct value, those inside one. Only about
``6 / accuracy`` of a group's rows lie inside, and the result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ACCURACY = 20_000


def _bracket_probs(probs: Sequence[float], accuracy: int) -> list[float]:
    slack = 3.0 / accuracy
    out: list[float] = []
    for p in probs:
        out += [max(0.0, p - slack), min(1.0, p + slack)]
    return out


def exact_quantiles(
    df: DataFrame, columns: str | Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per group, column and probability: ``by..., column, prob, quantile, n``.

    Nulls and NaN are left out, as usual for quantiles.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    by = list(by)
    probs = [float(p) for p in probs]
    long = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])).alias("_x"))
    long = long.select(*by, F.col("_x.column").alias("column"), F.col("_x.v").alias("v")) \
        .filter(F.col("v").isNotNull() & ~F.isnan("v"))
    keys = [*by, "column"]

    sketch = long.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.percentile_approx("v", _bracket_probs(probs, accuracy), accuracy).alias("_edges"))
    # Prefixed names keep the two branches of the self-join apart.
    brackets = sketch.select(
        *[F.col(k).alias(f"_b_{k}") for k in keys], F.col("n").alias("_n"), F.col("_edges").alias("_edges"))
    match = F.lit(True)
    for k in keys:
        match = match & long[k].eqNullSafe(brackets[f"_b_{k}"])
    if not by:
        # One row per requested column: bounded by the argument list, not by the data.
        brackets = F.broadcast(brackets)
    placed = long.join(brackets, match).select(*keys, "v", "_n", "_edges")

    # One group per stretch between bracket edges, except inside a bracket, where each distinct value is a group.
    stretch, inside = F.lit(0), F.lit(False)
    edges = [(F.element_at("_edges", 2 * i + 1), F.element_at("_edges", 2 * i + 2)) for i in range(len(probs))]
    for low, high in edges:
        stretch = stretch + (F.col("v") >= low).cast("int") + (F.col("v") > high).cast("int")
        inside = inside | F.col("v").between(low, high)
    counted = (
        placed.groupBy(*keys, stretch.alias("_stretch"), F.when(inside, F.col("v")).alias("_inside"))
        .agg(F.count("*").alias("rows"), F.min("v").alias("smallest"), F.max("v").alias("largest"),
             F.first("_n").alias("n"), F.first("_edges").alias("_edges")))

    # Rows per group from here on: the distinct values inside the brackets plus one per stretch outside.
    per_prob = counted.select(
        *keys, "rows", "smallest", "largest", "n", "_edges",
        F.posexplode(F.array(*[F.lit(p) for p in probs])).alias("i", "prob"))
    low = F.element_at("_edges", 2 * F.col("i") + 1)
    high = F.element_at("_edges", 2 * F.col("i") + 2)
    side = F.when(F.col("largest") < low, -1).when(F.col("smallest") > high, 1).otherwise(0)
    order = W.partitionBy(*keys, "i").orderBy("smallest").rowsBetween(W.unboundedPreceding, 0)
    position = F.col("prob") * (F.col("n") - 1)
    upto = per_prob.withColumns({
        "side": side, "upto": F.sum("rows").over(order), "rank": F.floor(position),
        "fraction": position - F.floor(position)})
    picked = upto.groupBy(*keys, "i", "prob", "n", "rank", "fraction").agg(
        F.min(F.when(F.col("upto") > F.col("rank"), F.struct("upto", "side", "largest"))).alias("lower"),
        F.min(F.when(F.col("upto") > F.col("rank") + 1, F.struct("upto", "smallest"))).alias("upper"))
    # The lower order statistic lies inside its bracket or, for a handful of rows, right below it.
    known = (F.col("lower.side") == 0) | ((F.col("lower.side") == -1) & (F.col("lower.upto") == F.col("rank") + 1))
    lower = F.when(~known, F.raise_error(F.lit("quantile outside its bracket")).cast("double")) \
        .otherwise(F.col("lower.largest"))
    upper = F.coalesce("upper.smallest", F.col("lower.largest"))
    return picked.select(*keys, "prob", (lower + (upper - lower) * F.col("fraction")).alias("quantile"), "n")


def quantile_columns(
    df: DataFrame, column: str, named: dict[str, float], by: Sequence[str] = (), accuracy: int = ACCURACY,
) -> DataFrame:
    """Exact quantiles of one column as one row per group, one named column per probability."""
    by = list(by)
    rows = exact_quantiles(df, column, sorted(set(named.values())), by, accuracy)
    aggs = [F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("quantile"))).alias(name) for name, p in named.items()]
    return rows.groupBy(*by).agg(*aggs) if by else rows.agg(*aggs)


def approx_quantile_columns(
    df: DataFrame, column: str, named: dict[str, float], by: Sequence[str] = (), accuracy: int = ACCURACY,
) -> DataFrame:
    """One-pass approximate variant with a rank error of at most ``rows / accuracy``."""
    aggs = [F.percentile_approx(column, float(p), accuracy).alias(name) for name, p in named.items()]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def scalar(one_row: DataFrame, name: str) -> Column:
    """A value of a one-row frame as a scalar subquery (no join)."""
    return one_row.select(name).scalar()
