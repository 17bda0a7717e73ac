"""Features of one spectrum, as expressions on ``array<struct<freq,value>>``.

Each feature is available on its own, as a fold over the array; :func:`extract_features` takes all sums and extremes of a
spectrum from one Arrow-batched function, which adds in the order of the folds and gives the same numbers. No row is
exploded and nothing shuffles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rotorlens.functions.numeric import scrub
from rotorlens.schema import EDA_EPS, EDA_TEMP, EPS, LOW_BAND_END_HZ, MID_BAND_END_HZ, SPECTRAL_FEATURES

#: Points of spectra that are handled at once.
POINTS = 1 << 18
_FOLDS = ("total", "energy", "energy_low", "energy_mid", "energy_high", "squares", "largest", "smallest", "dominant")


def _zero() -> Column:
    return F.lit(0.0)


def values(spectrum: Column) -> Column:
    return spectrum.getField("value")


def frequencies(spectrum: Column) -> Column:
    return spectrum.getField("freq")


def _in_band(freq: Column, start: float | None, end: float | None) -> Column:
    # NaN sorts above every number in Spark, so an open upper end has to exclude it.
    if start is None:
        return freq < F.lit(end)
    if end is None:
        return (freq >= F.lit(start)) & ~F.isnan(freq)
    return (freq >= F.lit(start)) & (freq < F.lit(end))


def band_energy(spectrum: Column, start: float | None, end: float | None) -> Column:
    """Sum of squared amplitudes with ``start <= freq < end``; None leaves that end open."""
    return F.aggregate(
        spectrum, _zero(),
        lambda acc, x: acc + F.when(_in_band(x["freq"], start, end), x["value"] * x["value"]).otherwise(_zero()))


def energy(spectrum: Column) -> Column:
    return F.aggregate(values(spectrum), _zero(), lambda acc, v: acc + v * v)


def rms(spectrum: Column) -> Column:
    return F.sqrt(F.try_divide(energy(spectrum), F.size(spectrum)))


def max_amplitude(spectrum: Column) -> Column:
    return F.array_max(values(spectrum))


def mean_amplitude(spectrum: Column) -> Column:
    return F.try_divide(F.aggregate(values(spectrum), _zero(), lambda acc, v: acc + v), F.size(spectrum))


def _std_around(vals: Column, mean: Column) -> Column:
    # The one-element array binds the mean, so that it is not worked out again for every element of the fold.
    def spread(m: Column) -> Column:
        squares = F.aggregate(vals, _zero(), lambda acc, v: acc + (v - m) * (v - m))
        return F.sqrt(F.try_divide(squares, F.size(vals)))

    return F.transform(F.array(mean), spread)[0]


def std_amplitude(spectrum: Column) -> Column:
    """Population standard deviation, on centred values."""
    return _std_around(values(spectrum), mean_amplitude(spectrum))


def peak_to_peak(spectrum: Column) -> Column:
    return F.array_max(values(spectrum)) - F.array_min(values(spectrum))


def crest_factor(spectrum: Column, eps: float = EPS) -> Column:
    return max_amplitude(spectrum) / (rms(spectrum) + F.lit(eps))


def energy_low(spectrum: Column, low_end: float = LOW_BAND_END_HZ) -> Column:
    return band_energy(spectrum, None, low_end)


def energy_mid(spectrum: Column, low_end: float = LOW_BAND_END_HZ, mid_end: float = MID_BAND_END_HZ) -> Column:
    return band_energy(spectrum, low_end, mid_end)


def energy_high(spectrum: Column, mid_end: float = MID_BAND_END_HZ) -> Column:
    return band_energy(spectrum, mid_end, None)


def ratio_low(spectrum: Column, eps: float = EPS) -> Column:
    return energy_low(spectrum) / (energy(spectrum) + F.lit(eps))


def ratio_mid(spectrum: Column, eps: float = EPS) -> Column:
    return energy_mid(spectrum) / (energy(spectrum) + F.lit(eps))


def ratio_high(spectrum: Column, eps: float = EPS) -> Column:
    return energy_high(spectrum) / (energy(spectrum) + F.lit(eps))


def dominant_frequency(spectrum: Column) -> Column:
    """Frequency of the first maximum."""
    vals = values(spectrum)
    position = F.array_position(vals, F.array_max(vals)).cast("int")
    return F.when(F.size(spectrum) > 0, F.element_at(frequencies(spectrum), position)).otherwise(_zero())


def dominant_peak(spectrum: Column) -> Column:
    """struct<freq, amplitude> at the first maximum."""
    return F.struct(dominant_frequency(spectrum).alias("freq"), max_amplitude(spectrum).alias("amplitude"))


def harmonic_energy(spectrum: Column, f0: Column, k: int, tolerance: float = 0.05) -> Column:
    """Energy within ``tolerance`` (relative) of the k-th multiple of the rotation frequency ``f0``."""
    centre = f0 * F.lit(float(k))
    return F.aggregate(
        spectrum, _zero(),
        lambda acc, x: acc + F.when(F.abs(x["freq"] - centre) <= centre * F.lit(tolerance), x["value"] * x["value"])
        .otherwise(_zero()))


def _sums(x: np.ndarray) -> np.ndarray:
    """Row sums from left to right; ``cumsum`` adds one by one, unlike ``sum``."""
    return 0.0 + x.cumsum(axis=1)[:, -1]


def _folded(freq: np.ndarray, value: np.ndarray, known: np.ndarray | None, low_end: float, mid_end: float) -> tuple[np.ndarray, np.ndarray]:
    """(``_FOLDS`` by row, which of them are known) of spectra of one length, 1 at least. ``known`` tells values that are
    not null (None: all); a null frequency is NaN, which lies in no band."""
    rows, width = value.shape
    square = value * value
    bands = (freq < low_end, (freq >= low_end) & (freq < mid_end), freq >= mid_end)
    out, valid = np.empty((len(_FOLDS), rows)), np.ones((len(_FOLDS), rows), bool)
    total, energy = _sums(value), _sums(square)
    gap = value - (total / width)[:, None]
    out[:6] = total, energy, *[_sums(np.where(b, square, 0.0)) for b in bands], _sums(gap * gap)
    row = np.arange(rows)
    largest, smallest = value, np.where(np.isnan(value), np.inf, value)  # NaN is the largest, as in Spark
    none, all_nan = np.zeros(rows, bool), np.isnan(value).all(axis=1)
    if known is not None:
        none = ~known.any(axis=1)
        all_nan = (np.isnan(value) | ~known).all(axis=1)
        largest, smallest = np.where(known, value, -np.inf), np.where(known, smallest, np.inf)
        valid[[0, 1, 5]] = known.all(axis=1)
        for k, b in enumerate(bands):
            valid[2 + k] = ~(b & ~known).any(axis=1)
    at = largest.argmax(axis=1)  # the first one, or the first NaN
    if known is not None:  # a null stands for the least number, which a known value may be as well
        at = np.where(known[row, at], at, known.argmax(axis=1))
    out[6:] = value[row, at], np.where(all_nan, np.nan, smallest[row, smallest.argmin(axis=1)]), freq[row, at]
    valid[6:] = ~none
    return out, valid


def _folds_of(column: pa.Array, low_end: float, mid_end: float) -> pa.StructArray:
    """``_FOLDS`` of every spectrum as a struct; of an empty spectrum the sums are 0 and the others null."""
    lists = column.offsets.to_numpy()
    size = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(lists), -1)
    points = column.values
    there = points.is_valid() if points.null_count else None

    def part(name: str) -> tuple[np.ndarray, np.ndarray | None]:
        field = points.field(name).cast(pa.float64())
        if not field.null_count and there is None:
            return field.to_numpy(), None
        valid = field.is_valid() if there is None else pc.and_(field.is_valid(), there)
        valid = valid.to_numpy(zero_copy_only=False)
        return np.where(valid, field.fill_null(0.0).to_numpy(zero_copy_only=False), np.nan), valid

    (freq, _), (value, known) = part("freq"), part("value")
    out, valid = np.zeros((len(_FOLDS), len(size))), np.zeros((len(_FOLDS), len(size)), bool)
    valid[:6] = size >= 0
    for width in np.unique(size[size > 0]).tolist():
        same = np.flatnonzero(size == width)
        step = max(1, POINTS // width)
        for a in range(0, len(same), step):
            rows = same[a:a + step]
            at = lists[rows, None].astype(np.int64) + np.arange(width)
            out[:, rows], valid[:, rows] = _folded(freq[at], value[at], None if known is None else known[at], low_end, mid_end)
    return pa.StructArray.from_arrays([pa.array(o, mask=~v) for o, v in zip(out, valid)], names=list(_FOLDS))


def _folds(spectrum: Column, low_end: float, mid_end: float) -> Column:
    @F.arrow_udf(", ".join(f"{c} double" for c in _FOLDS))
    def spectrum_folds(column: pa.Array) -> pa.Array:
        with np.errstate(all="ignore"):
            return _folds_of(column, low_end, mid_end)

    # Non-deterministic only for the planner: it runs once per row, and no filter on a result moves below it.
    return spectrum_folds.asNondeterministic()(spectrum)


def extract_features(
    spectra: DataFrame,
    eps: float = EPS,
    fixed_temp: float | None = None,
    low_end: float = LOW_BAND_END_HZ,
    mid_end: float = MID_BAND_END_HZ,
    keep: tuple[str, ...] = ("record_id", "dev_eui", "mode", "axis", "ts_ms"),
) -> DataFrame:
    """All 15 features plus the metadata columns of ``keep`` that exist; non-finite results become 0.

    Works unchanged on batch and streaming frames.
    """
    kept = [c for c in keep if c in spectra.columns]
    spectrum = F.col("spectrum")
    temp = F.lit(fixed_temp) if fixed_temp is not None else F.col("temp")
    bound = spectra.select(*kept, temp.alias("temp"), F.size(spectrum).alias("_n"), _folds(spectrum, low_end, mid_end).alias("_folds"))
    folded = bound.select(
        *kept, "temp", "_n",
        *[F.col(f"_folds.{c}").alias(c) for c in ("energy", "energy_low", "energy_mid", "energy_high")],
        F.col("_folds.largest").alias("max_amplitude"),
        F.col("_folds.smallest").alias("_min"),
        F.when(F.col("_n") > 0, F.col("_folds.dominant")).otherwise(_zero()).alias("dominant_frequency"),
        F.try_divide(F.col("_folds.total"), F.col("_n")).alias("mean_amplitude"),
        F.sqrt(F.try_divide(F.col("_folds.squares"), F.col("_n"))).alias("std_amplitude"),
    )
    means = folded.withColumn("rms", F.sqrt(F.try_divide(F.col("energy"), F.col("_n"))))
    total = F.col("energy") + F.lit(eps)
    complete = means.withColumns({
        "peak_to_peak": F.col("max_amplitude") - F.col("_min"),
        "crest_factor": F.col("max_amplitude") / (F.col("rms") + F.lit(eps)),
        "ratio_low": F.col("energy_low") / total,
        "ratio_mid": F.col("energy_mid") / total,
        "ratio_high": F.col("energy_high") / total,
    })
    numbers = [c for c in ("mode", "axis", "ts_ms") if c in kept]
    return complete.select(
        *[scrub(F.col(c)).alias(c) if c in numbers else F.col(c) for c in kept],
        *[scrub(F.col(c).cast("double")).alias(c) for c in SPECTRAL_FEATURES],
    )


def extract_features_eda(spectra: DataFrame) -> DataFrame:
    """Exploratory variant: smaller epsilon and a constant temperature."""
    return extract_features(spectra, eps=EDA_EPS, fixed_temp=EDA_TEMP)


def rule_diagnosis(
    spectrum: Column,
    f0: Column,
    share: float = 0.2,
    harmonic_share: float = 0.1,
    min_harmonics: int = 3,
    max_harmonic: int = 5,
    high_share: float = 0.5,
    tolerance: float = 0.05,
) -> Column:
    """Rule-based cause from harmonic shares of the total energy (thresholds are parameters).

    Order: much high-band energy, several harmonics, dominant first harmonic, dominant second harmonic.
    """
    total = energy(spectrum) + F.lit(EPS)
    shares = F.array(*[harmonic_energy(spectrum, f0, k, tolerance) / total for k in range(1, max_harmonic + 1)])
    strong = F.size(F.filter(shares, lambda s: s >= F.lit(harmonic_share)))
    first, second = F.element_at(shares, 1), F.element_at(shares, 2)
    return (
        F.when(ratio_high(spectrum) >= high_share, F.lit("bearing"))
        .when(strong >= min_harmonics, F.lit("looseness"))
        .when((first >= share) & (first >= second), F.lit("imbalance"))
        .when(second >= share, F.lit("misalignment"))
        .otherwise(F.lit("undetermined"))
    )
