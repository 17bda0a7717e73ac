"""Scalar expressions on numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rotorlens.schema import CONTAMINATION_MAX, CONTAMINATION_MIN, CONTAMINATION_ROWS

# Decimal text forms that count as a number (fixed pattern, matched on the lower-cased text).
NUMBER_PATTERN = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def py_float(text: Column) -> Column:
    """Text to double, null when the text is not a plain decimal number.

    ``try_cast`` alone would also take Java forms (``1d``, ``1f``, hex). Those always hold one of the letters d, f or x,
    so only texts with such a letter pay for the full pattern; plain digits take the fast way.
    """
    plain = ~text.rlike("[dDfFxX]") | F.lower(text).rlike(NUMBER_PATTERN)
    return F.when(plain, text).try_cast("double")


def scrub(value: Column) -> Column:
    """NaN, infinities and null become 0."""
    return F.when(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")), F.lit(0.0)).otherwise(value)


def scrub_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: scrub(F.col(c).cast("double")) for c in columns})


def percent(part: Column, total: Column) -> Column:
    """100 * part / total, 0 when the total is 0."""
    return F.when(total > 0, 100.0 * part / total).otherwise(F.lit(0.0))


def adaptive_contamination(rows: Column) -> Column:
    """Share of records taken as anomalous, growing with the number of rows between two limits."""
    return F.least(F.lit(CONTAMINATION_MAX), F.greatest(F.lit(CONTAMINATION_MIN), rows / F.lit(float(CONTAMINATION_ROWS))))


def contamination_for(rows: int) -> float:
    return min(CONTAMINATION_MAX, max(CONTAMINATION_MIN, rows / CONTAMINATION_ROWS))
