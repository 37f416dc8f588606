"""One query per operator, over its whole table, and SQL oracles where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import (
    fill_in_middle,
    language_id,
    licenses,
    nearest,
    ngram_join,
    oracles,
    positional_index,
    quality,
    sentence_pieces,
    source_mix,
    substring_index,
    subvector_clusters,
    suffix_dedup,
    url_filter,
)
from feedloom.llm.tables import small_batches, table

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

URL_RULES = url_filter.rules(
    "allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"
)


def held_out(key: str = "doc_id"):
    """One row in five by its key; a row without a key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.similar_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional_index.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled URLs are those of the table that a rule decides."""
    pages = table(spark, sf_dir, "pages")
    labelled = url_filter.judge(pages, URL_RULES, None).where(F.col("rule").isNotNull())
    model = url_filter.fit(
        labelled.withColumn("label", (F.col("verdict") == url_filter.BLOCK).cast("int"))
    )
    return url_filter.judge(pages, URL_RULES, model)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    marks = (
        documents.select("doc_id")
        .where(~held_out())
        .join(labels.where(F.col("quality").isNotNull()), "doc_id", "left")
        .withColumn("good", F.col("quality") == 1)
        .withColumn("web", F.col("quality").isNull())
    )
    scored = quality.score(documents, quality.fit(documents, marks, "good", "web"))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    network = language_id.fit(documents.where(~held_out()))
    found = language_id.predict(documents, network)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_index.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentence_pieces.encode(
        table(spark, sf_dir, "documents"), PIECE_MODEL, outputs=("ids", "begins", "ends", "decoded")
    )

    def joined(name: str):
        return F.array_join(F.col(name).cast("array<string>"), ",")

    spans = F.concat_ws(";", joined("begins"), joined("ends"))
    return found.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(joined("ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), F.sha2(spans, 256).alias("spans_sha256"),
    )


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document belongs to the one source that it names."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = source_mix.mix(documents, F.array("source"))
    sources = found.sources.select(
        F.col("source").alias("named"), F.col("size").alias("source_size"), "target"
    )
    own = F.col("sources")[0].eqNullSafe(F.col("named"))
    return found.rows.join(sources, own).select("doc_id", "size", "source_size", "target", "taken")


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = subvector_clusters.cluster(table(spark, sf_dir, "embeddings"))
    return subvector_clusters.described(found).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.pieces(table(spark, sf_dir, "documents")))


Query = Callable[[SparkSession, str], DataFrame]


def _in_small_batches(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    f.__name__: _in_small_batches(f)
    for f in (
        op1_ngram_join, op2_license_scan, op3_decontamination, op4_url_filter, op5_quality,
        op6_language_id, op7_substring_dedup, op8_suffix_dedup, op9_sentence_pieces, op10_nearest,
        op11_source_mix, op12_centroid_clusters, op13_fill_in_middle,
    )
}

ORACLES: dict[str, str] = {
    "op1_ngram_join": oracles.NGRAM_JOIN,
    "op3_decontamination": oracles.DECONTAMINATION,
    "op7_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op8_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op12_centroid_clusters": oracles.CENTROID_CLUSTERS,
    "op13_fill_in_middle": oracles.FILL_IN_MIDDLE,
}
