"""URL filters with dated lists (native): entries become validity intervals, captures are judged as of their fetch time.

A list entry says that from a moment on a host, a domain or a path prefix is blocked or allowed again. Per key the
entries become intervals without overlap; a capture looks its keys up (the host, its parent domains, and the host with
each leading part of the path) and takes the interval that holds its fetch time. The longest key with a verdict decides.
Only ids, times and keys are shuffled. The intervals of a key travel as one sorted array, so a capture meets one row per
key and a host with very many captures is split by adaptive execution like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and a final dot; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*?)\.?(?::\d*)?(?:[/?#]|$)", 1))


def path_of(url: Column) -> Column:
    """The path without query and fragment, with one leading slash."""
    return F.concat(F.lit("/"), F.regexp_extract(
        F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/*([^?#]*)", 1))


def keys_of(url: Column, path_parts: int | None = None) -> Column:
    """Keys that may carry an entry, without repeats: host and parent domains of two labels or more, host with each
    leading part of the path. No entry has more than ``path_parts`` path parts, if that is known; None: all are keys."""
    labels = F.split(host_of(url), r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
                          lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    parts = F.array_remove(F.split(path_of(url), "/"), "")
    depth = F.size(parts) if path_parts is None else F.least(F.size(parts), F.lit(path_parts))
    paths = F.when(depth > 0, F.transform(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))), lambda k: F.concat(
        host_of(url), F.lit("/"), F.array_join(F.slice(parts, 1, k), "/")))).otherwise(F.array().cast("array<string>"))
    return F.when(host_of(url) == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(domains, paths)))


def intervals(entries: DataFrame, key: str = "key", since: str = "since", blocked: str = "blocked") -> DataFrame:
    """key, valid_from, valid_to (null: still), blocked, from dated entries.

    Entries that repeat the verdict before them are folded; of several at one moment, a block wins. Null keys, times and
    verdicts are left out. A key has one row per change of its verdict.
    """
    dated = entries.select(F.col(key).alias("key"), F.col(since).alias("at"), F.col(blocked).alias("blocked")).where(
        F.col("key").isNotNull() & F.col("at").isNotNull() & F.col("blocked").isNotNull())
    once = dated.groupBy("key", "at").agg(F.max("blocked").alias("blocked"))
    order = Window.partitionBy("key").orderBy("at")
    changes = once.select("*", F.lag("blocked").over(order).alias("before")).where(~F.col("blocked").eqNullSafe(F.col("before")))
    return changes.select("key", F.col("at").alias("valid_from"), F.lead("at").over(order).alias("valid_to"), "blocked")


def url_verdicts(captures: DataFrame, entries: DataFrame, capture_id: str = "page_id", url: str = "url",
                 fetched: str = "fetched_at") -> DataFrame:
    """capture_id, fetched_at, key, valid_from, blocked: one row per input row.

    ``entries``: key, since, blocked. Captures with a null url, an unreadable one or a null time, and those no entry is
    active for, are not blocked (key null). Rows that repeat an id with the same url and time are judged as one and
    come back as often as they were given. Empty tables: no rows, or nothing blocked. Extra columns are ignored.
    Paths are looked up as deep as the deepest entry goes, which one count over the entries finds.
    """
    deepest = entries.agg(F.max(F.size(F.split("key", "/")) - 1)).first()[0] or 0
    asked = captures.select(F.col(capture_id).alias("capture_id"), F.col(fetched).alias("fetched_at"),
                            keys_of(F.col(url), deepest).alias("keys"))
    each = asked.groupBy("capture_id", "fetched_at", "keys").agg(F.count("*").cast("int").alias("times"))
    lists = intervals(entries).groupBy("key").agg(F.sort_array(F.collect_list(F.struct(
        "valid_from", "valid_to", "blocked"))).alias("states"))
    state = F.get(F.filter("states", lambda s: (s["valid_from"] <= F.col("fetched_at")) & (
        s["valid_to"].isNull() | (F.col("fetched_at") < s["valid_to"]))), 0)
    looked = each.select("*", F.explode_outer("keys").alias("key")).join(lists, "key", "left").select(
        "capture_id", "fetched_at", "keys", "times", "key", state.alias("s"))
    best = looked.groupBy("capture_id", "fetched_at", "keys", "times").agg(F.max(F.when(F.col("s").isNotNull(), F.struct(
        F.length("key").alias("n"), F.col("key"), F.col("s.valid_from").alias("valid_from"),
        F.col("s.blocked").alias("blocked")))).alias("best"))
    return best.select("capture_id", "fetched_at", F.col("best.key").alias("key"), "best.valid_from", F.coalesce(
        "best.blocked", F.lit(False)).alias("blocked"), F.explode(F.sequence(F.lit(1), F.col("times")))).drop("col")


def allowed_captures(captures: DataFrame, entries: DataFrame, capture_id: str = "page_id", **options) -> DataFrame:
    """The rows of ``captures`` whose id has no blocked capture."""
    gone = url_verdicts(captures, entries, capture_id, **options).where("blocked").select(
        F.col("capture_id").alias(capture_id)).distinct()
    return captures.join(gone, capture_id, "left_anti")
