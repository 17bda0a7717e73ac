"""Declared schemas, feature lists, label dimensions and default parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- Fixed values: column names, labels, bands and thresholds that results depend on ---

SPECTRAL_FEATURES = [
    "rms", "energy", "max_amplitude", "mean_amplitude", "std_amplitude",
    "peak_to_peak", "crest_factor", "temp",
    "energy_low", "energy_mid", "energy_high",
    "ratio_low", "ratio_mid", "ratio_high", "dominant_frequency",
]
MODEL_INPUTS = SPECTRAL_FEATURES + ["mode", "axis"]
BOX_FEATURES = ["rms", "energy_low", "energy_mid", "energy_high", "dominant_frequency", "crest_factor"]

LOW_BAND_END_HZ = 30.0
MID_BAND_END_HZ = 70.0
EPS = 1e-8
EDA_EPS = 1e-10
EDA_TEMP = 20.0

FAULT_LABELS = {
    0: "Type 0 - High Std Amplitude - holgura / impacto mecánico",
    1: "Type 1 - High Energy Mid-Frequency - desalineación",
    2: "Type 2 - High Energy Low-Frequency - desbalance mecánico",
    3: "Type 3 - Balanced Multi-Band Energy - degradación general",
}
NORMAL_CODE = -1
NORMAL_DESCRIPTION = "Comportamiento normal"
NORMAL_ALERT_LABEL = "Normal"
UNKNOWN_ALERT_LABEL = "Desconegut"

# Display translation. One consistent meaning per code (codes 2 and 3 keep their own meaning).
LABEL_TRANSLATION = {
    FAULT_LABELS[0]: "Tipus 0 - Alta Desv. Amplitud - folgança / impacte mecànic",
    FAULT_LABELS[1]: "Tipus 1 - Alta Energia Freqüència Mitja - desalineació",
    FAULT_LABELS[2]: "Tipus 2 - Alta Energia Freqüència Baixa - desequilibri mecànic",
    FAULT_LABELS[3]: "Tipus 3 - Energia Multi-Banda - degradació general",
    NORMAL_DESCRIPTION: "Comportament normal",
}

AXIS_LABELS = {1.0: "X", 2.0: "Y", 3.0: "Z"}
SEVERITY_HIGH_CONFIDENCE = 0.5
SEVERITY_MEDIUM_CONFIDENCE = 0.3
SEVERITY_HIGH_QUANTILE = 0.80
SEVERITY_MEDIUM_QUANTILE = 0.50
SEVERITY_RANKS = {"HIGH": 0, "MEDIUM": 1, "LOW": 2, "NONE": 3}

CONTAMINATION_MIN = 0.10
CONTAMINATION_MAX = 0.20
CONTAMINATION_ROWS = 10000
N_CLUSTERS = 4
SILHOUETTE_SAMPLE = 5000
SILHOUETTE_GOOD = 0.5
SILHOUETTE_MODERATE = 0.3

# --- Schemas ---

_STRING_LEAF = T.StructType([T.StructField("S", T.StringType())])
_NUMBER_LEAF = T.StructType([T.StructField("N", T.StringType())])
_READING = T.StructType([
    T.StructField("M", T.StructType([
        T.StructField("frequency", _NUMBER_LEAF),
        T.StructField("value", _NUMBER_LEAF),
    ])),
])
CORRUPT_COLUMN = "_corrupt"
LINE_SCHEMA = T.StructType([
    T.StructField("line", T.ArrayType(T.StructType([T.StructField("Item", T.StructType([
        T.StructField("dev_eui", _STRING_LEAF),
        T.StructField("mode", _NUMBER_LEAF),
        T.StructField("axis", _NUMBER_LEAF),
        T.StructField("timestamp", _NUMBER_LEAF),
        T.StructField("T1", _NUMBER_LEAF),
        T.StructField("readings", T.StructType([T.StructField("L", T.ArrayType(_READING))])),
    ]))]))),
    T.StructField(CORRUPT_COLUMN, T.StringType()),
])

SPECTRUM_TYPE = T.ArrayType(T.StructType([
    T.StructField("freq", T.DoubleType()),
    T.StructField("value", T.DoubleType()),
]))

META_COLUMNS = ["dev_eui", "mode", "axis", "timestamp"]
FEATURES_SCHEMA = T.StructType(
    [T.StructField("record_id", T.StringType()), T.StructField("dev_eui", T.StringType()),
     T.StructField("mode", T.DoubleType()), T.StructField("axis", T.DoubleType()),
     T.StructField("ts_ms", T.DoubleType())]
    + [T.StructField(c, T.DoubleType()) for c in SPECTRAL_FEATURES]
)

PREDICTION_SCHEMA = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("is_anomaly", T.BooleanType()),
    T.StructField("fault_type", T.IntegerType()),
    T.StructField("fault_description", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("probabilities", T.MapType(T.StringType(), T.DoubleType())),
])


def fault_dimension(spark: SparkSession) -> DataFrame:
    """The fault code dimension: one row per known code, the normal code included."""
    rows = [(code, label) for code, label in FAULT_LABELS.items()] + [(NORMAL_CODE, NORMAL_ALERT_LABEL)]
    return spark.createDataFrame(rows, "fault_type int, fault_label string")


def severity_dimension(spark: SparkSession) -> DataFrame:
    rows = [(level, rank) for level, rank in SEVERITY_RANKS.items() if level != "NONE"]
    return spark.createDataFrame(rows, "severity_level string, sev_rank int")
