"""Quantiles, ranks, copies, temporal filters, tables: against brute force, with one key holding most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rotorlens.operators import alerts as A
from rotorlens.operators import filters as FL
from rotorlens.operators import joins as J
from rotorlens.operators import quantiles as Q
from rotorlens.operators import report as R
from rotorlens.operators import sampling as S
from rotorlens.sources import tables as TB

RNG = np.random.default_rng(5)
PROBS = [0.0, 0.01, 0.25, 0.5, 0.8, 0.999, 1.0]


def test_quantiles_are_exact_with_coarse_sketch_skew_and_ties(spark):
    n = 20000
    pdf = pd.DataFrame({"g": RNG.choice(["a", "b", "c"], n, p=[0.7, 0.299, 0.001]),
                        "x": np.where(RNG.random(n) < 0.35, 0.0, RNG.normal(size=n)),
                        "y": RNG.integers(0, 4, n).astype(float)})
    df = spark.createDataFrame(pdf).repartition(7)
    for r in Q.exact_quantiles(df, ["x", "y"], PROBS, ["g"], accuracy=200).collect():
        values = pdf[pdf.g == r["g"]][r["column"]]
        assert r["quantile"] == pytest.approx(np.quantile(values, r["prob"]), abs=1e-12)
        assert r["n"] == len(values)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 11])
def test_quantiles_of_few_rows(spark, n):
    values = [float(v * v) for v in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    for r in Q.exact_quantiles(df, "x", PROBS).collect():
        assert r["quantile"] == pytest.approx(np.quantile(values, r["prob"]), abs=1e-12)


def test_hash_rank_is_a_permutation_and_ignores_partitioning(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("record_id"),
                                  F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("g"))
    one, two = (S.hash_rank(d, ["g"]).toPandas() for d in (df, df.repartition(3)))
    for g, size in (("hot", 4000), ("cold", 1000)):
        assert sorted(one[one.g == g].hash_rank) == list(range(1, size + 1))
    assert dict(zip(one.record_id, one.hash_rank)) == dict(zip(two.record_id, two.hash_rank))
    capped = S.group_sample_cap(df, ["g"], cap=300).toPandas()
    assert set(capped.record_id) == set(one[one.hash_rank <= 300].record_id)


def test_copies_get_their_own_ids(spark):
    df = spark.createDataFrame([("a", 1.0)] * 2500 + [("b", 2.0)] * 3 + [("c", 3.0)], "record_id string, v double")
    out = S.number_copies(df, chunk=100).toPandas()
    assert len(out) == 2504 and out.record_id.nunique() == 2504
    assert out.groupby("v").size().to_dict() == {1.0: 2500, 2.0: 3, 3.0: 1}
    assert {"a", "a#2", "a#2500", "b#3", "c"} <= set(out.record_id)


def series_frame(spark, pdf):
    return spark.createDataFrame(pdf)


def make_series(n, times):
    return pd.DataFrame({
        "record_id": [f"r{i:06d}" for i in range(n)],
        "dev_eui": RNG.choice(["hot", "b"], n, p=[0.9, 0.1]), "mode": 1.0, "axis": RNG.choice([1.0, 2.0], n),
        "ts_ms": times, "is_anomaly": RNG.random(n) < 0.3})


@pytest.mark.parametrize("times", ["spread", "one moment", "few moments"])
@pytest.mark.parametrize("rows_per_block", [50, 10_000])
def test_persistence_by_rows(spark, times, rows_per_block):
    import hashlib
    n = 800
    ts = {"spread": RNG.integers(0, 10**6, n), "one moment": np.zeros(n), "few moments": RNG.integers(0, 4, n)}[times]
    pdf = make_series(n, ts.astype(float))
    out = A.persistence_by_rows(spark.createDataFrame(pdf), 5, 2, rows_per_block=rows_per_block).toPandas()
    pdf["tie"] = [hashlib.md5(f"42:{r}".encode()).hexdigest() for r in pdf.record_id]
    ordered = pdf.sort_values(["ts_ms", "tie", "record_id"])
    hits = ordered.groupby(["dev_eui", "mode", "axis"])["is_anomaly"].transform(
        lambda s: s.astype(int).rolling(5, min_periods=1).sum())
    expected = dict(zip(ordered.record_id, (hits >= 2) & ordered.is_anomaly))
    assert dict(zip(out.record_id, out.persistent)) == expected


def test_persistence_by_time(spark):
    pdf = make_series(400, RNG.integers(0, 5000, 400).astype(float))
    out = A.persistence_by_time(spark.createDataFrame(pdf), range_ms=100, minimum=3).toPandas()
    got = dict(zip(out.record_id, out.persistent))
    for r in pdf.itertuples():
        near = pdf[(pdf.dev_eui == r.dev_eui) & (pdf.axis == r.axis) & pdf.is_anomaly
                   & (pdf.ts_ms <= r.ts_ms) & (pdf.ts_ms >= r.ts_ms - 100)]
        assert got[r.record_id] == bool(r.is_anomaly and len(near) >= 3)


def test_extreme_and_combined(spark):
    pdf = make_series(300, np.arange(300.0)).assign(anomaly_score=RNG.normal(size=300), persistent=False)
    out = A.combined_flag(A.extreme_scores(spark.createDataFrame(pdf), 0.1)).toPandas()
    limit = pdf.groupby(["dev_eui", "mode", "axis"])["anomaly_score"].transform(lambda s: s.quantile(0.1))
    expected = dict(zip(pdf.record_id, pdf.anomaly_score < limit))
    assert dict(zip(out.record_id, out.confirmed)) == expected


def test_min_group_and_chronological(spark):
    pdf = make_series(500, RNG.integers(0, 1000, 500).astype(float))
    df = spark.createDataFrame(pdf)
    sizes = pdf.groupby(["dev_eui", "mode", "axis"])["record_id"].transform("size")
    assert FL.min_group_size(df, 60).count() == int((sizes >= 60).sum())
    ordered = A.chronological(df)
    parts = ordered.select(F.spark_partition_id().alias("p"), "dev_eui", "mode", "axis", "ts_ms").toPandas()
    for _, part in parts.groupby("p", sort=False):
        assert part[["dev_eui", "mode", "axis", "ts_ms"]].equals(
            part[["dev_eui", "mode", "axis", "ts_ms"]].sort_values(["dev_eui", "mode", "axis", "ts_ms"]))


def test_labels(spark):
    from rotorlens.functions import labels as L
    row = spark.range(1).select(
        L.short_label(F.lit("Type 1 - High Energy - DESALINEACIÓN eje")).alias("a"), L.short_label(F.lit("Normal")).alias("b"),
        L.axis_label(F.lit(4.0)).alias("c"), L.axis_label(F.lit(2.0)).alias("d"), L.mode_label(F.lit(3.0)).alias("e"),
        L.mode_label(F.lit(None).cast("double")).alias("f"), L.alert_label(F.lit(9)).alias("g"),
        L.alert_label(F.lit(-1)).alias("h"), L.fault_description(F.lit(9)).alias("i"),
        L.silhouette_verdict(F.lit(0.45)).alias("j"),
        L.severity_by_confidence(F.lit(0.3), F.lit(True)).alias("k"),
        L.severity_by_confidence(F.lit(0.9), F.lit(False)).alias("l")).first()
    assert list(row) == ["Desalineación eje", "Normal", "4.0", "Y", "3", "", "Desconegut", "Normal",
                         "Comportamiento normal", "moderate", "MEDIUM", "NONE"]


def test_joins(spark):
    left = spark.createDataFrame([("1", "a"), ("2", "b")], "record_id string, dev_eui string")
    right = spark.createDataFrame([("2", "z", 1), ("3", "z", 2)], "record_id string, dev_eui string, fault_type int")
    got = {tuple(r) for r in J.features_with_predictions(left, right).collect()}
    assert got == {("1", "a", None), ("2", "b", 1), ("3", None, 2)}
    assert {tuple(r) for r in J.predictions_left_metadata(right, left).collect()} == {("2", "z", 1), ("3", "z", 2)}


def test_box_histogram_and_examples(spark):
    pdf = pd.DataFrame({"record_id": [str(i) for i in range(200)], "fault_label": "f", "rms": RNG.normal(size=200),
                        "anomaly_score": RNG.normal(size=200), "is_anomaly": RNG.random(200) < 0.3})
    df = spark.createDataFrame(pdf)
    box = R.box_statistics(df, "rms").first()
    q1, q3 = np.quantile(pdf.rms, [0.25, 0.75])
    inside = pdf.rms.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    assert box["whisker_high"] == pytest.approx(pdf.rms[inside].max())
    assert box["outliers"] == int((~inside).sum()) == R.box_outliers(df, "rms").count()
    histogram = R.score_histogram(df).toPandas()
    for flag, part in pdf.groupby("is_anomaly"):
        counts, _ = np.histogram(part.anomaly_score, bins=30)
        got = histogram[histogram.is_anomaly == flag].set_index("bin")["n"].reindex(range(30), fill_value=0)
        assert list(got) == list(counts)
    picks = R.clearest_examples(df).toPandas()
    assert set(picks[picks["class"] == "Anomalia"].record_id) == set(
        pdf[pdf.is_anomaly].nsmallest(2, "anomaly_score").record_id)


def test_tables_roundtrip(spark, folder, sf):
    from rotorlens.plans import fixtures as fx
    features = fx.features(spark, sf)
    for fmt in ("parquet", "csv"):
        TB.write_features(features, f"{folder}/{fmt}", fmt)
        back = TB.read_features(spark, f"{folder}/{fmt}", fmt)
        assert back.schema == features.select(*back.columns).schema or back.columns == features.columns
        assert back.exceptAll(features.select(*back.columns)).count() == 0
    meta = TB.read_feature_metadata(spark, f"{folder}/parquet")
    assert meta.columns == ["record_id", "dev_eui", "mode", "axis", "ts_ms"]
    assert TB.read_feature_metadata(spark, f"{folder}/missing").count() == 0
    with pytest.raises(ValueError, match="missing columns.*axis"):
        TB.select_model_inputs(features.drop("axis"))


def test_predictions_roundtrip(spark, folder, sf):
    from rotorlens.plans import fixtures as fx
    predictions = fx.predictions(spark, sf).withColumn(
        "probabilities", F.create_map(F.lit("0"), F.lit(0.5), F.lit("1"), F.lit(0.5)))
    one = predictions.select("record_id", "is_anomaly", "fault_type", F.lit("desalineación").alias("fault_description"),
                             "confidence", "probabilities")
    TB.write_predictions_jsonl(one, f"{folder}/p")
    back = TB.read_predictions_jsonl(spark, f"{folder}/p")
    assert back.count() == 1000 and back.first()["probabilities"] == {"0": 0.5, "1": 0.5}
    assert back.filter("fault_description = 'desalineación'").count() == 1000
    alerts = TB.write_alert_tables(predictions, f"{folder}/out")
    assert alerts.count() == 200
    assert spark.read.parquet(f"{folder}/out/all_predictions").count() == 1000
    arrays = TB.predictions_as_json_array(one.withColumn("batch", F.lit("b")), "batch", batch_rows=100)
    lines = arrays.select(F.col("predictions").alias("value"))
    assert lines.count() > 5 and TB.parse_predictions(lines).count() == 1000
    with pytest.raises(ValueError):
        TB.predictions_as_json_array(one, "record_id", accept="text/csv")
    odd = spark.createDataFrame([("{}",), ("oops",), ("",), ("[1",), ('[{"fault_type":1},{"fault_type":2}]',)], "value string")
    assert TB.parse_predictions(odd).count() == 3
