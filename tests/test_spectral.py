import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rotorlens.functions import spectral as X
from rotorlens.schema import SPECTRAL_FEATURES, SPECTRUM_TYPE


def frame(spark, spectra):
    rows = [(str(i), "d", 1.0, 1.0, 0.0, 20.0, s) for i, s in enumerate(spectra)]
    return spark.createDataFrame(rows, "record_id string, dev_eui string, mode double, axis double, ts_ms double, "
                                       "temp double, spectrum " + SPECTRUM_TYPE.simpleString())


def features(spark, *spectra):
    rows = X.extract_features(frame(spark, spectra)).collect()
    return [r.asDict() for r in sorted(rows, key=lambda r: int(r["record_id"]))]


def test_hand_written(spark):
    tie, single, edges, zero, unsorted, negative, odd = features(
        spark, [(10.0, 2.0), (40.0, 2.0)], [(50.0, 3.0)], [(29.999, 1.0), (30.0, 1.0), (69.999, 1.0), (70.0, 1.0)],
        [(10.0, 0.0), (40.0, 0.0)], [(80.0, 1.0), (10.0, 5.0)], [(10.0, -5.0), (40.0, 1.0)],
        [(10.0, math.nan), (40.0, math.inf)])
    assert tie["dominant_frequency"] == 10
    assert (single["rms"], single["std_amplitude"], single["peak_to_peak"]) == (3, 0, 0)
    assert (single["energy_low"], single["energy_mid"], single["energy_high"]) == (0, 9, 0)
    assert (edges["energy_low"], edges["energy_mid"], edges["energy_high"]) == (1, 2, 1)
    assert [zero[c] for c in ("rms", "crest_factor", "ratio_low", "ratio_mid", "ratio_high")] == [0] * 5
    assert zero["dominant_frequency"] == 10
    assert (unsorted["dominant_frequency"], unsorted["energy_low"]) == (10, 25)
    assert (negative["max_amplitude"], negative["dominant_frequency"], negative["energy"]) == (1, 40, 26)
    assert odd["dominant_frequency"] == 10
    assert all(math.isfinite(odd[c]) for c in SPECTRAL_FEATURES)


def test_nan_frequency_is_in_no_band(spark):
    row = features(spark, [(math.nan, 2.0), (80.0, 1.0)])[0]
    assert (row["energy_low"], row["energy_mid"], row["energy_high"]) == (0, 0, 1)


spectrum = st.lists(st.tuples(st.floats(0, 120), st.floats(-50, 50)), min_size=1, max_size=30)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(spectrum, min_size=5, max_size=15))
def test_against_numpy(spark, spectra):
    for got, pairs in zip(features(spark, *spectra), spectra):
        f, v = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
        energy, rms = (v ** 2).sum(), np.sqrt((v ** 2).mean())
        expected = {
            "rms": rms, "energy": energy, "max_amplitude": v.max(), "mean_amplitude": v.mean(),
            "std_amplitude": v.std(), "peak_to_peak": v.max() - v.min(), "crest_factor": v.max() / (rms + 1e-8),
            "energy_low": (v[f < 30] ** 2).sum(), "energy_mid": (v[(f >= 30) & (f < 70)] ** 2).sum(),
            "energy_high": (v[f >= 70] ** 2).sum(), "dominant_frequency": f[v.argmax()],
            "ratio_high": (v[f >= 70] ** 2).sum() / (energy + 1e-8)}
        for name, value in expected.items():
            assert got[name] == pytest.approx(value, rel=1e-9, abs=1e-9), name


def test_single_features_equal_the_combined_ones(spark, sf):
    from rotorlens.plans import fixtures as fx
    spectra = fx.spectra(spark, sf)
    s = F.col("spectrum")
    alone = spectra.select("record_id", *[getattr(X, c)(s).alias(f"a_{c}") for c in SPECTRAL_FEATURES if c != "temp"])
    both = X.extract_features(spectra).join(alone, "record_id")
    off = both.filter(" OR ".join(f"abs({c} - a_{c}) > 1e-9" for c in SPECTRAL_FEATURES if c != "temp"))
    assert both.count() == 1000 and off.count() == 0


def test_eda_variant(spark):
    row = X.extract_features_eda(frame(spark, [[(10.0, 3.0)]])).first()
    assert row["temp"] == 20.0
    assert row["crest_factor"] == pytest.approx(3 / (3 + 1e-10), rel=1e-15)


def test_harmonics_and_rules(spark):
    imbalance, misalignment, loose, bearing, nothing = [
        [(10.0, 5.0), (20.0, 1.0)], [(10.0, 1.0), (20.0, 5.0)], [(10.0, 3.0), (20.0, 3.0), (30.0, 3.0), (40.0, 3.0)],
        [(80.0, 5.0), (10.0, 1.0)], [(13.0, 5.0)]]
    df = frame(spark, [imbalance, misalignment, loose, bearing, nothing]).select(
        "record_id", X.rule_diagnosis(F.col("spectrum"), F.lit(10.0)).alias("d"),
        X.harmonic_energy(F.col("spectrum"), F.lit(10.0), 1).alias("h"))
    got = {r["record_id"]: r for r in df.collect()}
    assert [got[str(i)]["d"] for i in range(5)] == ["imbalance", "misalignment", "looseness", "bearing", "undetermined"]
    assert got["0"]["h"] == 25.0


def test_nulls_and_not_a_number_as_the_single_features(spark):
    """Whole spectra of mixed lengths, with nulls at every level, give bit by bit what the folds give."""
    nan, inf = math.nan, math.inf
    odd = [None, [], [None], [(None, 1.0), (40.0, 2.0)], [(10.0, None), (40.0, 2.0)], [(80.0, None), (10.0, -inf)], [None, (10.0, nan), (75.0, 3.0)],
           [(10.0, nan), (40.0, nan)], [(10.0, -0.0), (40.0, 0.0)], [(nan, inf), (40.0, -inf)], [(30.0, 1e200), (70.0, 1e-200)],
           *[[(float(k), 0.1 * k + n) for k in range(n)] for n in (1, 64, 7, 64, 300)]]
    spectra = frame(spark, odd)
    s = F.col("spectrum")
    alone = spectra.select("record_id", *[X.scrub(getattr(X, c)(s)).alias(c) for c in SPECTRAL_FEATURES if c != "temp"])
    columns = ["record_id", *[c for c in SPECTRAL_FEATURES if c != "temp"]]
    both = [sorted(map(repr, df.select(columns).collect())) for df in (X.extract_features(spectra), alone)]
    assert both[0] == both[1]
    plan = X.extract_features(spectra)._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan  # such folds took most of a record's time
