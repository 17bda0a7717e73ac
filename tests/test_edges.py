"""Repeated lines, odd JSON, report labels, fractional times, null flags and keys, missing shared folder."""

import pytest
from pyspark.sql import functions as F

from rotorlens.operators import alerts as A
from rotorlens.operators import group_iforest as G
from rotorlens.operators import report as R
from rotorlens.operators.joins import features_with_predictions
from rotorlens.session import shared_dir
from rotorlens.sources import spectra as S
from rotorlens.sources import tables as TB

GOOD = ('{"Item":{"dev_eui":{"S":"d"},"mode":{"N":"1"},"axis":{"N":"1"},"T1":{"N":"20"},"timestamp":{"N":"5"},'
        '"readings":{"L":[{"M":{"frequency":{"N":"1.5"},"value":{"N":"2"}}}]}}}')


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_equal_lines_get_distinct_ids_and_do_not_multiply(spark):
    found = S.valid_spectra(S.parse_lines(S.numbered_lines(lines(spark, *[GOOD] * 200, "x", "x"))))
    assert found.count() == 200 and found.select("record_id").distinct().count() == 200
    joined = features_with_predictions(found.select("record_id", "dev_eui"), found.select("record_id", F.lit(True).alias("is_anomaly")))
    assert joined.count() == 200


def test_numbered_lines_are_read_from_files(spark, folder):
    lines(spark, GOOD, GOOD, GOOD).coalesce(1).write.text(f"{folder}/raw")
    assert S.read_spectra(spark, f"{folder}/raw").select("record_id").distinct().count() == 3


@pytest.mark.parametrize("text", [GOOD + ',"x":1', GOOD + "," + GOOD, GOOD + " tail", "[" + GOOD + "]", "null", ""])
def test_lines_with_more_than_one_record_are_malformed(spark, text):
    assert [r.discard_reason for r in S.parse_lines(lines(spark, text)).collect()] == ["malformed"]


def test_lenient_scan_takes_all_lines_by_default(spark, folder):
    many = GOOD.replace('"L":[', '"L":[' + '{"M":{"frequency":{"N":"1"},"value":{"N":"2"}}},' * 10)
    spark.range(6000).select(F.lit(many).alias("value")).write.text(f"{folder}/raw")
    assert S.read_spectra_lenient(spark, f"{folder}/raw").count() == 6000


def test_prediction_lines(spark):
    one = '{"record_id":"a","fault_type":1}'
    got = TB.parse_predictions(lines(spark, one, f"[{one},{one}]", f"{one},{one}", f"[1,{one}]", "{broken", "[]", "7", ""))
    assert got.count() == 4 and {r.record_id for r in got.collect()} == {"a"}


def test_pivot_counts_labels_in_both_wordings(spark):
    rows = [(k, "d", True, k % 4, 1.0, 0.9) for k in range(8)]
    scored = spark.createDataFrame(rows, "ts_ms int, dev_eui string, is_anomaly boolean, fault_type int, axis double, confidence double")
    plain = A.label_predictions(scored.withColumn("record_id", F.col("ts_ms").cast("string")))
    report = plain.withColumn("fault_label", A.translate_label(F.col("fault_label")))
    assert R.device_fault_pivot(plain).collect() == R.device_fault_pivot(report).collect()
    assert sum(list(R.device_fault_pivot(report).drop("dev_eui").first())) == 8
    odd = report.withColumn("fault_label", F.lit("something else"))
    assert R.device_fault_pivot(odd).first()["other"] == 8


def test_persistence_orders_by_exact_time(spark):
    rows = [(str(k), "d", 1.0, 1.0, 100.0 + k * 0.01, k in (3, 4)) for k in range(8)]
    df = spark.createDataFrame(rows, "record_id string, dev_eui string, mode double, axis double, ts_ms double, is_anomaly boolean")
    for size in (1_000_000, 2):
        flagged = A.persistence_by_rows(df, 2, 2, rows_per_block=size).where("persistent").collect()
        assert [r.record_id for r in flagged] == ["4"]


def test_persistence_blocks_with_one_common_time(spark):
    rows = [(f"{k:03d}", "d", 1.0, 1.0, 0.0 if k < 150 else float(k), k % 3 == 0) for k in range(200)]
    df = spark.createDataFrame(rows, "record_id string, dev_eui string, mode double, axis double, ts_ms double, is_anomaly boolean")
    whole, cut = (A.persistence_by_rows(df, 5, 2, rows_per_block=n).where("persistent").select("record_id").collect() for n in (10 ** 6, 20))
    assert sorted(whole) == sorted(cut)


def test_histogram_reads_a_missing_flag_as_normal(spark):
    df = spark.createDataFrame([(True, 0.1), (None, 0.2), (False, 0.3), (None, 0.4)], "is_anomaly boolean, anomaly_score double")
    assert {r.is_anomaly: r.n for r in R.score_histogram(df, bins=1).collect()} == {True: 1, False: 3}


def test_series_with_a_null_key_are_scored(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("record_id"), F.when(F.col("id") < 100, "d").alias("dev_eui"),
                                 (F.col("id") * 37 % 101).cast("double").alias("v"))
    models = G.group_forest_fit(df, ["v"], ["dev_eui"], trees=10)
    scored = G.group_forest_predict(df, models, ["v"], ["dev_eui"])
    assert scored.count() == 200 and scored.where("anomaly_score is null").count() == 0


def test_csv_report_frames_are_typed(spark, folder):
    spark.createDataFrame([("a", True, 1, 0.5)], "record_id string, is_anomaly boolean, fault_type int, confidence double") \
        .write.option("header", True).csv(f"{folder}/p")
    features = spark.createDataFrame([], TB.FEATURES_SCHEMA)
    TB.write_features(features, f"{folder}/f", "csv")
    types = dict(TB.read_report_frame(spark, f"{folder}/f", f"{folder}/p", "csv").dtypes)
    assert (types["is_anomaly"], types["fault_type"], types["confidence"]) == ("boolean", "int", "double")


def test_a_missing_metadata_table_is_empty_and_a_broken_one_an_error(spark, folder):
    assert TB.read_feature_metadata(spark, f"{folder}/none").count() == 0
    with open(f"{folder}/bad.parquet", "w") as file:
        file.write("no parquet")
    with pytest.raises(Exception):
        TB.read_feature_metadata(spark, f"{folder}/bad.parquet").count()


def test_a_cluster_has_to_name_its_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    cluster = type("S", (), {"conf": Conf(), "sparkContext": type("C", (), {"master": "yarn"})()})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(cluster)
