"""Standard and robust scaling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rotorlens.functions.numeric import scrub
from rotorlens.operators.quantiles import exact_quantiles


@dataclass(frozen=True)
class Scaler:
    """Centre and scale per column: a few numbers, fitted by one aggregation."""

    columns: tuple[str, ...]
    centres: tuple[float, ...]
    scales: tuple[float, ...]

    def expressions(self) -> dict[str, Column]:
        return {c: (scrub(F.col(c).cast("double")) - F.lit(m)) / F.lit(s)
                for c, m, s in zip(self.columns, self.centres, self.scales)}

    def transform(self, df: DataFrame) -> DataFrame:
        """Scaled columns under their own names."""
        return df.withColumns(self.expressions())

    def vector(self, df: DataFrame, name: str = "x") -> DataFrame:
        """All scaled columns as one array column next to the original ones."""
        return df.withColumn(name, F.array(*self.expressions().values()))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = list(zip(range(len(self.columns)), self.columns, self.centres, self.scales))
        return spark.createDataFrame(rows, "position int, column string, centre double, scale double")

    @staticmethod
    def from_frame(df: DataFrame) -> Scaler:
        rows = sorted(df.collect(), key=lambda r: r["position"])  # one row per model column
        return Scaler(*(tuple(r[c] for r in rows) for c in ("column", "centre", "scale")))


def _or_one(scale: float | None) -> float:
    return float(scale) if scale else 1.0


def standard_scale_fit(df: DataFrame, columns: Sequence[str]) -> Scaler:
    """Mean and population standard deviation; a constant column keeps scale 1."""
    aggs = []
    for c in columns:
        value = scrub(F.col(c).cast("double"))
        aggs += [F.avg(value), F.stddev_pop(value)]
    row = df.agg(*aggs).first()
    centres = tuple(float(row[2 * i] or 0.0) for i in range(len(columns)))
    scales = tuple(_or_one(row[2 * i + 1]) for i in range(len(columns)))
    return Scaler(tuple(columns), centres, scales)


def robust_scale_fit(df: DataFrame, columns: Sequence[str]) -> Scaler:
    """Median and interquartile range, exact."""
    scrubbed = df.select(*[scrub(F.col(c).cast("double")).alias(c) for c in columns])
    rows = exact_quantiles(scrubbed, list(columns), [0.25, 0.5, 0.75]).collect()  # 3 rows per column
    found = {(r["column"], r["prob"]): r["quantile"] for r in rows}
    return Scaler(tuple(columns), tuple(found[(c, 0.5)] for c in columns),
                  tuple(_or_one(found[(c, 0.75)] - found[(c, 0.25)]) for c in columns))
