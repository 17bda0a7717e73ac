"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rotorlens.llm import importance, language_model, lexical_search, line_dedup, mixing, neighbours, packing, quality_classifier, quality_rules, simhash, substring_dedup, token_files, url_filters
from rotorlens.llm.common import shared_folder, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).drop("n_lines", "n_upper")


def dated_list(pages: DataFrame) -> DataFrame:
    """key, since, blocked: a dated list made from the hosts, domains and paths of the pages, by their MD5."""
    host, path = url_filters.host_of(F.col("url")), url_filters.path_of(F.col("url"))
    seen = pages.select(host.alias("host"), F.concat_ws("/", host, F.get(F.array_remove(F.split(path, "/"), ""), 0)).alias(
        "part")).where(F.col("host") != "").distinct()
    number = lambda c: F.conv(F.substring(F.md5(c), 1, 6), 16, 10).cast("long")
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    hosts = seen.select(F.col("host").alias("key")).distinct().select("key", number(F.col("key")).alias("n"))
    domains = hosts.select(F.substring_index("key", ".", -2).alias("key")).distinct().select("key", number(F.col("key")).alias("n"))
    parts = seen.where("part <> host").select(F.col("part").alias("key")).distinct().select("key", number(F.col("key")).alias("n"))
    return (hosts.select("key", day(F.col("n") % 300).alias("since"), (F.col("n") % 3 == 0).alias("blocked"))
            .unionByName(hosts.where("n % 3 = 0").select("key", day(F.col("n") % 300 + 90).alias("since"), F.lit(False).alias("blocked")))
            .unionByName(domains.select("key", day(F.col("n") % 200).alias("since"), (F.col("n") % 4 == 0).alias("blocked")))
            .unionByName(parts.where("n % 5 = 0").select("key", day(F.col("n") % 330).alias("since"), (F.col("n") % 2 == 0).alias("blocked"))))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, as captured on a day that follows from its id, against the dated list."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.date_add(
        F.lit("2024-01-01").cast("date"), (F.col("page_id") * 37 % 366).cast("int")))
    return url_filters.url_verdicts(captures, dated_list(pages)).withColumnRenamed("capture_id", "page_id")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2("row.text", 256).alias("kept_sha256"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file())


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/llm/token-files-{uuid.uuid4().hex}"
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file())
    return token_files.with_starts(token_files.digests(token_files.read_tokens(spark, path)))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_url_filters": op2_url_filters,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_line_dedup": op4_line_dedup,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_mixing": op7_mixing,
    "op8_packing": op8_packing,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_token_files": op10_token_files,
    "op11_lexical_search": op11_lexical_search,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_language_model": op13_language_model,
}
