"""Row filters and column projections of the alert and training tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlens.functions.labels import mode_label

SERIES = ["dev_eui", "mode", "axis"]


def anomalies(df: DataFrame) -> DataFrame:
    return df.filter(F.coalesce("is_anomaly", F.lit(False)))


def alert_filter(
    alerts: DataFrame, severities: Sequence[str] | None = None, faults: Sequence[str] | None = None,
    severity_column: str = "severity_level", fault_column: str = "fault_label",
) -> DataFrame:
    """Alerts whose severity and fault label are both selected; None selects all."""
    if severities is not None:
        alerts = alerts.filter(F.col(severity_column).isin(list(severities)))
    if faults is not None:
        alerts = alerts.filter(F.col(fault_column).isin(list(faults)))
    return alerts


def plausible_temperature(df: DataFrame, low: float = -40.0, high: float = 150.0) -> DataFrame:
    return df.filter(F.col("temp").between(low, high))


def min_group_size(df: DataFrame, minimum: int = 50, by: Sequence[str] = SERIES) -> DataFrame:
    """Rows of groups with at least ``minimum`` rows.

    Groups are counted with map-side combine and joined back; a window count would put a whole group in one task.
    """
    counts = df.groupBy(*by).agg(F.count("*").alias("_rows")).filter(F.col("_rows") >= minimum)
    right = counts.select(*[F.col(c).alias(f"_g_{c}") for c in by])
    match = F.lit(True)
    for c in by:
        match = match & df[c].eqNullSafe(right[f"_g_{c}"])
    return df.join(right, match, "left_semi")


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


# Display names of the alert report (fixed values).
REPORT_COLUMNS = {
    "timestamp": "Timestamp",
    "dev_eui": "Dispositiu",
    "axis_label": "Eix",
    "mode": "Mode",
    "fault_label": "Tipus de Fallo",
    "severity_level": "Severitat",
}


def report_columns(df: DataFrame, names: Mapping[str, str] = REPORT_COLUMNS) -> DataFrame:
    """The report columns that exist, under their display names; the mode as whole-number text."""
    columns = []
    for source, shown in names.items():
        if source in df.columns:
            value = mode_label(F.col(source)) if source == "mode" else F.col(source)
            columns.append(value.alias(shown))
    return df.select(*columns)
