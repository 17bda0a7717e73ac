"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the library relies on. Everything else (memory, cores, shuffle service) belongs to the cluster.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "rotorlens", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A session within one process may do without the setting and gets a folder of its own; a cluster may not.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="rotorlens-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/rotorlens/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame, rows_per_partition: int | None = None) -> DataFrame:
    """Rebalance a frame read from fewer splits than there are cores, when heavy work per row follows.

    A table with more splits than cores passes through untouched, unless ``rows_per_partition`` asks for more of them: a
    split of narrow rows may hold millions. A stream doesn't tell its splits and is always dealt to all cores.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming:
        return df.repartition(wanted)
    if rows_per_partition is not None:
        wanted = max(wanted, -(-df.count() // rows_per_partition))
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def busy_partitions(spark: SparkSession) -> int:
    """Partition count for few but CPU-heavy groups. Given explicitly, adaptive execution does not merge them."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def training_partitions(df: DataFrame, rows_per_partition: int = 20_000) -> DataFrame:
    """Fewer partitions for iterative training on small tables, where tasks would cost more than their work."""
    wanted = max(1, -(-df.count() // rows_per_partition))
    return df.coalesce(wanted) if wanted < df.rdd.getNumPartitions() else df


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors and, unlike a cache, holds no executor memory.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*stored: DataFrame) -> None:
    """Delete tables of ``materialise`` that nothing reads any more."""
    for df in stored:
        for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
