"""Benchmark decontamination with a distributed positional inverted index.

DataFrame functions only. The index is a table of postings ``(term, doc, position)`` of the training
documents, in the shared folder. Phrases are found by intersecting lists whose positions are shifted by
each term's offset in the phrase, beginning with the term that has the fewest postings.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became lower case; null has none. Documents
are told apart by key and text, so rows that repeat a key keep their own results and fully repeated rows
get equal ones. Empty tables give empty lists, and so no hits. Items that repeat each other all count.
Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.tables import likely, stored

WINDOW_WORDS = 13
# Terms per phrase whose lists are intersected one by one before the rest is checked at once.
RAREST = 2

# Postings are looked up by stretches of so many words.
STRETCH = 32

_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_END = ""  # the term of a document's last posting, which stands behind its words


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    """The words of a text as an array."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), _BREAKS)
    return F.filter(parts, lambda w: w != "")


def phrases(items: DataFrame, key: str, text: str, length: int = WINDOW_WORDS) -> DataFrame:
    """Distinct windows of ``length`` words, with their items.

    An item of fewer words, but not none, is one window. Columns: ``phrase`` (its words), ``phrase_id``
    and ``items`` (the keys it comes from).
    """
    cut = items.select(F.col(key).alias("item"), words_of(F.col(text)).alias("words")).where(
        F.size("words") > 0
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (length - 1), F.lit(1)))
    windows = cut.select("item", F.explode(starts).alias("at"), "words").select(
        "item", F.slice("words", F.col("at"), F.lit(length)).alias("phrase")
    )
    return windows.groupBy("phrase").agg(F.collect_set("item").alias("items")).withColumn(
        "phrase_id", F.xxhash64(F.array_join("phrase", " "))
    )


def build_index(
    documents: DataFrame, key: str, text: str, terms: DataFrame | None = None
) -> DataFrame:
    """Postings ``(term, key, hash, position)`` of all documents, and one with the empty term behind each.

    ``hash`` is that of the text, and it stands for a key that is null. With ``terms`` (column ``term``)
    the postings of other terms are left out, but for the few whose hashes agree with one of them; no
    question about these terms reads those. No posting is shuffled.
    """
    at = F.posexplode(F.concat(words_of(F.col(text)), F.array(F.lit(_END))))
    own = F.coalesce(F.col(key), F.xxhash64(text).try_cast(documents.schema[key].dataType))
    postings = documents.select(
        own.alias("key"), F.xxhash64(text).alias("hash"), at.alias("position", "term")
    )
    if terms is not None:
        end = terms.sparkSession.createDataFrame([(_END,)], "term string")
        postings = likely(postings, terms.select("term").union(end), "term")
    return postings.select("term", "key", "hash", "position")


def _told(key: str) -> Column:
    """The key of a document in the index as it was."""
    return F.when(F.col("key").cast("string") == F.col("hash").cast("string"), None).otherwise(
        F.col("key")
    ).alias(key)


def find_phrases(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Every occurrence ``(phrase_id, key, hash, start, size)`` of the phrases in the index.

    Rows that repeat both key and text have equal postings; each occurrence is returned once.
    """
    counts = index.where(F.col("term") != _END).groupBy("term").agg(F.count("*").alias("n"))
    terms = wanted.select(
        "phrase_id", F.size("phrase").alias("size"),
        F.posexplode("phrase").alias("offset", "term"),
    )
    # A phrase with a term that never occurs has no occurrence.
    known = terms.join(counts, "term")
    ranked = stored(
        known.withColumn("rank", F.row_number().over(
            Window.partitionBy("phrase_id").orderBy("n", "offset")
        ))
        .withColumn("n_known", F.count("*").over(Window.partitionBy("phrase_id")))
        .where(F.col("n_known") == F.col("size"))
        .drop("n", "n_known"),
        "phrases",
    )
    postings = index.where(F.col("key").isNotNull())
    first = ranked.where("rank = 1")
    hits = likely(postings, first, "term").join(first, "term").select(
        "phrase_id", "key", "hash", (F.col("position") - F.col("offset")).alias("start"), "size"
    )
    hits = hits.where("start >= 0")
    for rank in range(2, RAREST + 1):
        # The lists of the next terms, shifted by their offsets.
        following = ranked.where(F.col("rank") == rank)
        shifted = likely(postings, following, "term").join(following, "term").select(
            "phrase_id", "key", "hash", (F.col("position") - F.col("offset")).alias("start")
        )
        short = hits.where(F.col("size") < rank)
        both = hits.where(F.col("size") >= rank).join(
            shifted, ["phrase_id", "key", "hash", "start"], "left_semi"
        )
        hits = both.union(short)
    hits = stored(hits.distinct(), "phrase-candidates")
    rest = ranked.where(F.col("rank") > RAREST)
    probes = hits.join(rest.select("phrase_id", "term", "offset"), "phrase_id").select(
        "phrase_id", "key", "hash", "start", "size", "term",
        (F.col("start") + F.col("offset")).alias("position"),
    )
    stretch = F.floor(F.col("position") / STRETCH).alias("stretch")
    asked = probes.select("key", "hash", stretch).distinct()
    lists = likely(postings.select("*", stretch), asked, "key", "hash", "stretch")
    full = (
        probes.join(lists.drop("stretch"), ["key", "hash", "position", "term"])
        .groupBy("phrase_id", "key", "hash", "start", "size")
        .agg(F.count_distinct("position").alias("n"))
        .where(F.col("n") == F.col("size") - RAREST)
        .drop("n")
    )
    return full.union(hits.where(F.col("size") <= RAREST))


def find_near(index: DataFrame, questions: DataFrame, within: int) -> DataFrame:
    """Documents where all terms of a question stand within so many words of each other.

    ``questions``: ``phrase_id`` and ``phrase`` (its terms; a repeated term counts once). Returns
    ``(phrase_id, key, hash, at)`` for each place ``at`` of the question's rarest term for which every
    other term has a posting in some stretch of ``within`` words that holds ``at``.
    """
    counts = index.where(F.col("term") != _END).groupBy("term").agg(F.count("*").alias("n"))
    terms = questions.select(
        "phrase_id", F.size(F.array_distinct("phrase")).alias("size"),
        F.explode(F.array_distinct("phrase")).alias("term"),
    )
    ranked = terms.join(counts, "term").withColumn(
        "rank", F.row_number().over(Window.partitionBy("phrase_id").orderBy("n", "term"))
    )
    lists = index.join(ranked.select("term").distinct(), "term", "left_semi")
    anchors = lists.join(ranked.where("rank = 1"), "term").select(
        "phrase_id", "key", "hash", F.col("position").alias("at"), "size"
    )
    others = lists.join(ranked.where("rank > 1"), "term").select(
        "phrase_id", "key", "hash", "position", "term"
    )
    # Postings meet in blocks of ``within`` words: one of the two blocks around an anchor holds them.
    block = lambda place: F.floor(place / within)
    reach = anchors.select(
        "*", F.explode(F.array(*[block(F.col("at")) + i for i in (-1, 0, 1)])).alias("block")
    )
    near = reach.join(
        others.withColumn("block", block(F.col("position"))), ["phrase_id", "key", "hash", "block"]
    ).where(F.abs(F.col("position") - F.col("at")) < within)
    spot = ["phrase_id", "key", "hash", "at", "size"]
    # For every first place of a stretch, the terms that lie in it.
    stretch = F.explode(
        F.sequence(
            F.greatest(F.col("at"), F.col("position")) - (within - 1),
            F.least(F.col("at"), F.col("position")),
        )
    )
    full = (
        near.select(*spot, "term", stretch.alias("from"))
        .groupBy(*spot, "from")
        .agg(F.count_distinct("term").alias("n"))
        .where(F.col("n") == F.col("size") - 1)
        .select(*spot)
        .distinct()
    )
    return full.union(anchors.where("size = 1")).drop("size")


def contamination(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """How much of every document stands in the benchmark.

    Returns per row the key, ``hash`` (of the text), ``n_words``, ``n_hit`` (words inside an occurrence
    of a window), ``n_items``, ``items`` (the keys of items with occurring windows, sorted as strings)
    and ``contaminated`` (n_hit > 0 and 20 * n_hit >= n_words). A row without a key goes by its text.
    """
    wanted = stored(phrases(benchmark, item_key, item_text), "benchmark-windows")
    terms = wanted.select(F.explode("phrase").alias("term")).distinct()
    index = stored(build_index(documents, key, text, terms), "postings")
    found = find_phrases(index, wanted)
    ends = index.where(F.col("term") == _END).select(
        "key", "hash", F.col("position").cast("bigint").alias("n_words")
    )
    in_order = Window.partitionBy("key", "hash").orderBy("start", "stop")
    reached = F.max("stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    spans = found.select(
        "key", "hash", "phrase_id", "start", (F.col("start") + F.col("size")).alias("stop")
    )
    covered = (
        spans.withColumn("reached", F.coalesce(reached, F.lit(0)))
        .withColumn(
            "own", F.greatest(F.col("stop") - F.greatest("start", "reached"), F.lit(0))
        )
        .groupBy("key", "hash")
        .agg(F.sum("own").alias("n_hit"), F.collect_set("phrase_id").alias("phrase_ids"))
    )
    items = (
        covered.select("key", "hash", F.explode("phrase_ids").alias("phrase_id"))
        .join(wanted.select("phrase_id", F.explode("items").alias("item")), "phrase_id")
        .groupBy("key", "hash")
        .agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    )
    hits = covered.drop("phrase_ids").join(items, ["key", "hash"], "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0))
    listed = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return ends.join(hits, ["key", "hash"], "left").select(
        _told(key), "hash", "n_words", n_hit.alias("n_hit"),
        F.size(listed).cast("bigint").alias("n_items"), listed.alias("items"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )
