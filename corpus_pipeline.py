"""A corpus pipeline: language, near duplicates, repeated passages, contamination, tokenizer round trip.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table that the next one reads as ``docs``. All
but the last keep the columns of ``documents``:

1. ``language``: texts without a letter or a readable language go.
2. ``near_duplicates``: of each group of linked documents the one with the smallest id stays, and of
   rows that repeat both id and text one (the least by the other columns).
3. ``repeated_passages``: words of passages that an earlier document holds go, and texts left without a
   word with them. Texts without such passages are not touched.
4. ``decontamination``: documents that the benchmark contaminates go.
5. ``pieces``: every text as SentencePiece ids with byte spans, and the text they decode to.

A document is told by its id and its text: texts that share an id are judged apart. A null id is in no
group of near duplicates and in no earlier document, so its row stays there unless it is a repeated row;
what its text holds of the benchmark counts. A null or empty text is rejected by the first stage. Very
long texts are read whole. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import (
    language_id,
    ngram_join,
    positional_index,
    queries,
    sentence_pieces,
    substring_index,
)
from feedloom.llm.tables import small_batches, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    network = language_id.fit(docs.where(~queries.held_out()))
    found = language_id.predict(docs, network, keep=COLUMNS)
    return found.where(F.col("lang_pred") != language_id.UNDETERMINED).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = stored(
        ngram_join.similar_groups(docs).select("doc_id", "text_hash", "group_id"), "similar"
    )
    document = ["doc_id", "text_hash"]
    # Of a group the document with the smallest id, of those the one whose text hashes lowest.
    first = F.min(F.struct(*document)).alias("first")
    chosen = found.where("group_id IS NOT NULL").groupBy("group_id").agg(first).select("first.*")
    alone = found.where("group_id IS NULL").select(*document).distinct()
    stay = chosen.unionByName(alone)
    hashed = docs.select(*COLUMNS).withColumn("text_hash", F.xxhash64("text"))

    def among(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        """Rows whose document is among these, or is not; a null id is an id."""
        ids = ids.toDF("_id", "_hash")
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
        return rows.join(ids, same, how)

    several = found.groupBy(*document).agg(F.count("*").alias("n")).where("n > 1").select(*document)
    kept = among(hashed, stay, "left_semi")
    # Only rows that repeat both id and text are brought together.
    once = among(kept, several, "left_anti").select(*COLUMNS)
    least = F.min(F.struct(*COLUMNS)).alias("row")
    repeated = among(kept, several, "left_semi").groupBy(*document).agg(least).select("row.*")
    return once.unionByName(repeated)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = substring_index.remove_repeats(docs, keep=COLUMNS)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    cut = found.where("n_removed < n_words").withColumn("text", text)
    return cut.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = positional_index.contamination(docs, table(spark, sf_dir, "benchmark"))
    dirty = stored(found.where("contaminated").select("doc_id", "hash").distinct(), "contaminated")
    dirty = dirty.toDF("_id", "_hash")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    return docs.join(dirty, same, "left_anti").select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return sentence_pieces.encode(
        docs, queries.PIECE_MODEL, outputs=("ids", "begins", "ends", "decoded")
    )


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("pieces", pieces),
]

# Models and a tokenizer are not SQL; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
