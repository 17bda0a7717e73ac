"""Scan of JSON lines with typed leaves (``{"Item": {"mode": {"N": "1"}, ...}}``) into spectra.

``parse_lines`` is a narrow transformation of any frame with a ``value`` column, so files, streams and derived
frames take the same way. The record id is a hash of the line, not a position; ``numbered_lines`` tells copies apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rotorlens.functions.numeric import py_float
from rotorlens.operators.sampling import hash_sample, number_copies
from rotorlens.schema import CORRUPT_COLUMN, LINE_SCHEMA
from rotorlens.session import materialise

SPECTRA_COLUMNS = ["record_id", "dev_eui", "mode", "axis", "ts_ms", "temp", "spectrum"]
LENIENT_MIN_POINTS = 10


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw lines. ``spark.read.json`` would drop blank lines, which have to be counted."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return spark.readStream.options(**options).text(path)


#: Lines that may hold an explicit null, or text that closes the list around the record: the only ones parsed twice.
#: A plain search for ``null`` is several times as fast as one more branch of the pattern.
_CLOSED = r"\]\s*,"
_LEAVES = ("mode", "axis", "timestamp", "T1")


def _json(lines: DataFrame, nulls: bool = False) -> DataFrame:
    """``nulls``: an explicit null where a record or its readings are looked at makes the line malformed. Parsed to a
    schema, it would look like a missing value, which has a default."""
    # The parser stops after one complete value. Wrapped as the one element of a list, text behind the record is an
    # error as well, or makes the list longer. A line that closes the list itself doesn't fit into an object.
    wrapped = F.concat(F.lit('{"line":['), F.col("value"), F.lit("]}"))
    parsed = F.from_json(wrapped, LINE_SCHEMA, {"columnNameOfCorruptRecord": CORRUPT_COLUMN})
    own = F.col("record_id") if "record_id" in lines.columns else F.sha2(F.col("value"), 256)
    odd = F.col("value").contains("null") | F.col("value").rlike(_CLOSED)
    within = F.concat(F.lit('{"line":'), F.col("value"), F.lit("}"))
    return (lines.select(own.alias("record_id"), parsed.alias("_j"), odd.alias("_odd"), F.when(odd, F.try_parse_json(within)).alias("_v"))
            .select("record_id", F.when(F.size("_j.line") == 1, F.get("_j.line", 0)).alias("line"),
                    F.col(f"_j.{CORRUPT_COLUMN}").isNotNull().alias("_corrupt"),
                    (F.col("_odd") & (F.col("_v").isNull() | (_holds_nulls(F.col("_v")) if nulls else F.lit(False)))).alias("_refused"))
            .select("record_id", "line", (F.col("line").isNull() | F.col("_corrupt") | F.col("_refused")).alias("_malformed")))


def _null_at(v: Column, path: str) -> Column:
    return F.coalesce(F.is_variant_null(F.try_variant_get(v, path, "variant")), F.lit(False))


def _holds_nulls(v: Column) -> Column:
    """Nulls that damage a record. One in the device's name, or in a reading without both leaves, does not."""
    found = F.lit(False)
    for path in ("", ".readings", ".dev_eui", *[f".{x}" for x in _LEAVES], *[f".{x}.N" for x in _LEAVES]):
        found = found | _null_at(v, f"$.line.Item{path}")

    def damaged(entry: Column) -> Column:
        both = F.try_variant_get(entry, "$.M.frequency", "variant").isNotNull() & F.try_variant_get(entry, "$.M.value", "variant").isNotNull()
        inner = F.lit(False)
        for path in ("$.M.frequency", "$.M.value", "$.M.frequency.N", "$.M.value.N"):
            inner = inner | _null_at(entry, path)
        return _null_at(entry, "$") | _null_at(entry, "$.M") | (both & inner)

    return found | F.coalesce(F.exists(F.try_variant_get(v, "$.line.Item.readings.L", "array<variant>"), damaged), F.lit(False))


#: So many distinct repeated lines, 8 bytes each, are sent to all tasks.
REPEATS_SENT = 2_000_000


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``value`` with a ``record_id`` that no other line has: the line's hash, for further copies with a number.

    Short hashes alone are counted first, at once. Only lines whose hash repeats are shuffled, to be counted as rows and
    re-created with their numbers; all others stay where they are read, as long as the repeated hashes are few enough to
    be sent to all tasks. Lines that merely share a short hash are told apart by the count of whole rows.
    """
    hashed = lines.select("value", F.xxhash64("value").alias("_h"))
    again = materialise(hashed.groupBy("_h").agg(F.count("*").alias("n")).where("n > 1").select("_h"), "repeated-lines")
    repeats = again.count()
    keyed = hashed.select(F.sha2(F.col("value"), 256).alias("record_id"), "value", "_h")
    if not repeats:
        return keyed.drop("_h")
    side = F.broadcast(again) if repeats <= REPEATS_SENT else again
    return keyed.join(side, "_h", "left_anti").drop("_h").unionByName(number_copies(keyed.join(side, "_h", "left_semi").drop("_h")))


def _number(field: str) -> Column:
    return F.col(f"line.Item.{field}.N")


def _bad_number(text: Column) -> Column:
    return text.isNotNull() & py_float(text).isNull()


def parse_lines(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Lines to spectra, every line kept: ``discard_reason`` is null for valid records.

    ``strict`` treats a reading with a good frequency and a bad value as damage to the whole record
    (``misaligned``); otherwise only that reading is dropped.
    """
    readings = F.col("line.Item.readings.L")
    # An entry without both leaves is no reading at all: its frequency stays null, and null frequencies are dropped.
    pairs = F.transform(readings, lambda r: F.struct(
        F.when(r["M"]["value"].isNotNull(), py_float(r["M"]["frequency"]["N"])).alias("freq"),
        py_float(r["M"]["value"]["N"]).alias("value")))
    numbers = {"mode": -1.0, "axis": -1.0, "timestamp": 0.0, "T1": 0.0}
    bad_metadata = F.lit(False)
    for field in numbers:
        bad_metadata = bad_metadata | _bad_number(_number(field))

    staged = _json(lines, nulls=True).select(
        "record_id",
        "_malformed",
        F.col("line.Item").isNull().alias("_no_item"),
        F.col("line.Item.readings").isNull().alias("_no_readings"),
        (F.coalesce(F.size(readings), F.lit(0)) <= 0).alias("_empty"),
        bad_metadata.alias("_bad_metadata"),
        F.coalesce(F.col("line.Item.dev_eui.S"), F.lit("unknown")).alias("dev_eui"),
        *[F.coalesce(py_float(_number(field)), F.lit(default)).alias(name)
          for (field, default), name in zip(numbers.items(), ("mode", "axis", "ts_ms", "temp"))],
        pairs.alias("_pairs"),
    )
    # Most records have nothing to drop; one short check spares them the other passes over the array.
    damaged = F.exists("_pairs", lambda p: p["freq"].isNull() | p["value"].isNull())
    whole = F.filter("_pairs", lambda p: p["freq"].isNotNull() & p["value"].isNotNull())
    checked = staged.select("*", damaged.alias("_damaged"))
    sized = checked.select("*", F.when(F.col("_damaged"), whole).otherwise(F.col("_pairs")).alias("spectrum"))
    reason = (
        F.when(F.col("_malformed"), "malformed")
        .when(F.col("_no_item"), "no_item")
        .when(F.col("_no_readings"), "no_readings")
        .when(F.col("_empty"), "empty_list")
        .when(F.size("spectrum") <= 0, "no_values")
        .when(F.col("_bad_metadata"), "bad_metadata")
    )
    if strict:
        misaligned = F.exists("_pairs", lambda p: p["freq"].isNotNull() & p["value"].isNull())
        reason = reason.when(F.col("_damaged") & misaligned, "misaligned")
    row = F.struct(*SPECTRA_COLUMNS[:-1], "spectrum", reason.alias("discard_reason"))
    # One struct per line through a generator: a filter on the reason then stays above it. Pushed below, it would
    # repeat the JSON parsing inside the predicate.
    return sized.select(F.inline(F.array(row)))


def valid_spectra(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("discard_reason").isNull()).select(*SPECTRA_COLUMNS)


def discard_counts(parsed: DataFrame) -> DataFrame:
    """Records per outcome; valid ones appear as ``valid``."""
    return (parsed.groupBy(F.coalesce("discard_reason", F.lit("valid")).alias("outcome"))
            .agg(F.count("*").alias("n")))


def read_spectra(spark: SparkSession, path: str | list[str], strict: bool = True) -> DataFrame:
    return valid_spectra(parse_lines(numbered_lines(read_lines(spark, path)), strict))


def parse_lines_lenient(
    lines: DataFrame, limit: int | None = None, min_points: int = LENIENT_MIN_POINTS, seed: int = 42,
) -> DataFrame:
    """Exploratory scan: missing frequency or value counts as 0, only spectra with more than ``min_points`` stay.

    ``limit`` takes that many lines in hash order (a frame has no first lines); None takes all.
    """
    if limit is not None:
        lines = hash_sample(lines, limit, "value", seed)

    def leaf(node: Column) -> Column:
        return F.when(node["N"].isNull(), F.lit(0.0)).otherwise(py_float(node["N"]))

    readings = F.filter("line.Item.readings.L", lambda r: r["M"].isNotNull())
    pairs = F.transform(readings, lambda r: F.struct(leaf(r["M"]["frequency"]).alias("freq"),
                                                     leaf(r["M"]["value"]).alias("value")))
    row = F.struct("record_id", F.when(~F.col("_malformed"), pairs).alias("spectrum"))
    parsed = _json(lines).select(F.inline(F.array(row)))
    broken = F.exists("spectrum", lambda p: p["freq"].isNull() | p["value"].isNull())
    return parsed.filter((F.size("spectrum") > min_points) & ~broken)


def read_spectra_lenient(
    spark: SparkSession, path: str | list[str], limit: int | None = None,
    min_points: int = LENIENT_MIN_POINTS, seed: int = 42,
) -> DataFrame:
    return parse_lines_lenient(read_lines(spark, path), limit, min_points, seed)
