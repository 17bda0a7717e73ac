import glob

from pyspark.sql import functions as F

from rotorlens.functions.spectral import extract_features
from rotorlens.plans import fixtures as fx
from rotorlens.plans.table_queries import text_stream
from rotorlens.session import shared_dir, spread
from rotorlens.sources import spectra as S
from rotorlens.streaming import streams as ST


def test_stream_of_files_equals_batch(spark, sf, folder):
    fx.raw_lines(spark, sf).repartition(5).write.text(f"{folder}/raw")
    stream = ST.stream_features(S.stream_lines(spark, f"{folder}/raw", maxFilesPerTrigger="2"))
    table = ST.run_available(stream, f"{folder}/out")
    batch = extract_features(S.read_spectra(spark, f"{folder}/raw"))
    assert table.count() == batch.count() == 780
    assert table.exceptAll(batch).count() == 0
    # New files only on the second run.
    fx.lines_from(fx.spectra(spark, sf).filter("event_id = 0")).write.mode("append").text(f"{folder}/raw")
    assert ST.run_available(stream, f"{folder}/out").count() == 781


def test_late_records_are_dropped(spark, folder):
    schema = "record_id string, dev_eui string, mode double, axis double, ts_ms double, is_anomaly boolean"
    hour = 3_600_000.0

    def put(name, times):
        rows = [(f"{name}{i}", "d", 1.0, 1.0, t * hour, True) for i, t in enumerate(times)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def run(make):
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        out = ST.run_available(make(stream), f"{folder}/{make.__name__}")
        return [tuple(r) for r in out.orderBy(*out.columns).collect()]

    def periods(s):
        return ST.alerts_per_period(s).select("dev_eui", F.unix_seconds("period_start").alias("p"), "alerts")

    def windows(s):
        return ST.persistent_windows(s).select("dev_eui", F.unix_seconds("window_start").alias("w"), "anomalies")

    put("a", [1, 2, 30])
    assert run(periods) == [("d", 0, 2)]
    assert ("d", 0, 2) in run(windows)
    put("b", [3, 60])  # hour 3 is behind the watermark (30 - 1)
    assert run(periods) == [("d", 0, 2), ("d", 86400, 1)]
    assert all(n == 2 for _, w, n in run(windows) if w == 0)


def test_updates_have_every_window(spark, folder):
    schema = "record_id string, dev_eui string, mode double, axis double, ts_ms double, is_anomaly boolean"
    for part, hours in enumerate(([1, 2, 30], [31, 60])):
        rows = [(f"{part}-{h}", "d", 1.0, 1.0, h * 3_600_000.0, True) for h in hours]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = ST.alerts_per_period(spark.readStream.schema(schema).parquet(f"{folder}/in"))
        out = ST.run_updates(stream, ["dev_eui", "period_start"], f"{folder}/out")
        got = sorted((int(r.p) // 86400, r.alerts) for r in out.select(F.unix_seconds("period_start").alias("p"), "alerts").collect())
        assert got == ([(0, 2), (1, 1)] if part == 0 else [(0, 2), (1, 2), (2, 1)])


def test_streams_of_few_splits_are_dealt_to_all_cores(spark, folder):
    """One small file of narrow rows is a single split, but every row becomes a spectrum."""
    rows = spark.range(20_000).selectExpr("id as event_id", "timestamp'2024-01-01 00:00:00' as ts", "id % 7 as user_id", "rand(1) as value")
    rows.coalesce(1).write.parquet(f"{folder}/events")
    shapes = spark.createDataFrame([(k, [0.5] * 8, k) for k in range(4)], "vec_id long, embedding array<float>, label int")
    parts = []
    stream = fx.spectra_from(spark.readStream.schema(rows.schema).parquet(f"{folder}/events"), shapes)
    query = (stream.writeStream.foreachBatch(lambda batch, _: parts.append(batch.rdd.getNumPartitions()))
             .trigger(availableNow=True).option("checkpointLocation", f"{folder}/checkpoint").start())
    query.awaitTermination()
    assert parts == [spark.sparkContext.defaultParallelism]


def test_splits_of_many_narrow_rows_are_cut(spark):
    rows = spark.range(1000, numPartitions=8)
    assert spread(rows, 10).rdd.getNumPartitions() == 100
    assert spread(rows).rdd.getNumPartitions() == 8 and spread(rows, 1000).rdd.getNumPartitions() == 8


def test_lines_of_the_text_stream_are_stored_compressed(spark, sf):
    before = set(glob.glob(f"{shared_dir(spark)}/rotorlens/stream-*"))
    assert text_stream(spark, sf).count()
    made, = set(glob.glob(f"{shared_dir(spark)}/rotorlens/stream-*")) - before
    assert glob.glob(f"{made}/raw/*.gz") and not glob.glob(f"{made}/raw/*.txt")


def test_lines_with_and_without_numbers(spark):
    """A number that is null is left out of its line; the text of all others is that of the JSON writer."""
    spectrum = "array(struct(1.5D as freq, 0.25D as value), struct(3.0D as freq, cast(null as double) as value), struct(4.5D as freq, double('NaN') as value))"
    frame = spark.sql(f"select 1L as event_id, 'd' as dev_eui, 1D as mode, 2D as axis, 5D as ts_ms, 20D as temp, {spectrum} as spectrum")
    line = fx.lines_from(frame).first()["value"]
    assert ('[{"M":{"frequency":{"N":"1.5"},"value":{"N":"0.25"}}},{"M":{"frequency":{"N":"3.0"},"value":{}}},'
            '{"M":{"frequency":{"N":"4.5"},"value":{"N":"NaN"}}}]') in line
