"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, as a regular-expression class and as its characters.
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a session on this one machine may do without the setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, label: str, files: int | None = None, compression: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder and read back: it survives lost executors and cuts the lineage.

    At most ``files`` files are written (by default twice the cores), not one per shuffle partition: every file costs
    calls to the file system, and many small ones would slow down the readers.
    """
    path = f"{shared_folder(df.sparkSession)}/llm/{label}-{uuid.uuid4().hex}"
    df.coalesce(files or 2 * df.sparkSession.sparkContext.defaultParallelism).write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_key(df: DataFrame) -> DataFrame:
    """_row (the whole row), _file, _at: two numbers that no other row has and that stay the same when read again.

    A plain table of files names its rows by file and place. Any other table is stored first, since its rows may come
    in another order when it is computed again.
    """
    if "_metadata" not in df.columns and df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        try:
            return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.xxhash64("_metadata.file_path").alias("_file"),
                             F.col("_metadata.row_index").alias("_at"))
        except AnalysisException:
            pass  # a kind of file that doesn't count its rows
    return stored(df.select(F.struct("*").alias("_row"), F.lit(0).cast("long").alias("_file"),
                            F.monotonically_increasing_id().alias("_at")), "rows")


def small(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """``df``, to be broadcast if a count of it finds at most ``rows`` narrow rows; otherwise Spark picks the join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` or a lambda in it uses it."""
    return F.transform(F.array(value), body)[0]


def text_of(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(text: Column) -> Column:
    """The maximal runs of characters other than white space, as an array."""
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def occurrences(text: Column, character_class: str) -> Column:
    """How many characters of ``text`` belong to the class."""
    return (F.size(F.split(text, character_class, -1)) - 1).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case, all other characters as they are."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower()))


def parts_for(df: DataFrame, least: int = 1) -> int:
    """A partition count for CPU-heavy work on few rows: the session's, but not fewer than its cores."""
    spark = df.sparkSession
    return max(least, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
