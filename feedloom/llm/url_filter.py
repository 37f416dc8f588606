"""URL filters: rules for hosts and paths, and a logistic model where no rule fits.

DataFrame functions and Spark's own learner only; nothing here runs Python on the executors.

A URL's host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower
case; its path goes from there up to ``?``, ``#`` or the end. Null and texts without ``://`` have
neither: both are empty, and they are judged by the model like others.

A rule ``host/path`` fits its host and all subdomains where the path starts with the rule's. The longest
rule that fits decides; of equally long ones, the one with the longer host, then the one that blocks.

Elsewhere a logistic regression over hashed character n-grams of host and path decides. It is fitted on
a small labelled URL table; ties at 0.5 are allowed through, and so is everything when the table is
empty. A table with one label only gives that label. Rows are independent: repeated rows, nulls and
further columns do not matter.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
N_GRAMS = (3, 4)
BUCKETS = 1 << 12
MOST_RULES = 10_000
LABELLED_ROWS = 4_000


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str  # with its leading slash

    @property
    def text(self) -> str:
        return self.host + self.path


def rules(*lines: str) -> list[Rule]:
    """Rules from lines such as ``allow org/`` or ``block example.org/es/``."""
    out = []
    for line in lines:
        verdict, _, target = line.partition(" ")
        host, slash, path = target.partition("/")
        if verdict not in (ALLOW, BLOCK) or not host:
            raise ValueError(f"not a rule: {line}")
        out.append(Rule(verdict, host, slash + path))
    if len(out) > MOST_RULES:
        raise ValueError("rules are part of the plan; join a table for so many")
    return out




def _lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return _lower_ascii(_part(url, r"(?s)^.*?://([^/?#]*)"))


def path_of(url: Column) -> Column:
    return _part(url, r"(?s)^.*?://[^/?#]*([^?#]*)")


def _part(url: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))


def matching_rule(host: Column, path: Column, known: list[Rule]) -> Column:
    """The deciding rule as a struct with ``text`` and ``verdict``; null where none fits."""
    if not known:
        return F.lit(None).cast("struct<text:string,verdict:string>")
    by_host: dict[str, list[Rule]] = {}
    for rule in known:
        by_host.setdefault(rule.host, []).append(rule)
    entries = []
    for name, own in by_host.items():
        options = F.array(
            *[
                F.struct(
                    F.lit(len(r.text)).alias("size"), F.lit(len(r.host)).alias("host_size"),
                    F.lit(r.verdict).alias("verdict"), F.lit(r.text).alias("text"),
                    F.lit(r.path).alias("path"),
                )
                for r in own
            ]
        )
        entries += [F.lit(name), options]
    table = F.create_map(*entries)
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    options = F.flatten(
        F.filter(F.transform(suffixes, lambda s: F.try_element_at(table, s)), F.isnotnull)
    )
    best = F.array_max(F.filter(options, lambda r: path.startswith(r["path"])))
    return F.when(
        best.isNotNull(), F.struct(best["text"].alias("text"), best["verdict"].alias("verdict"))
    )


def n_grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, marked by where they come from."""

    def of(text: Column, mark: str) -> Column:
        edged = F.concat(F.lit("^"), text, F.lit("$"))
        parts = [
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.length(edged) - (n - 1), F.lit(1))),
                lambda i, n=n: F.concat(F.lit(mark), F.substr(edged, i, F.lit(n))),
            )
            for n in N_GRAMS
        ]
        return F.concat(*parts)

    return F.concat(of(host, "h:"), of(path, "p:"))


def _vectors(df: DataFrame, host: Column, path: Column) -> DataFrame:
    hashed = HashingTF(inputCol="_grams", outputCol="_vector", numFeatures=BUCKETS, binary=True)
    return hashed.transform(df.withColumn("_grams", n_grams(host, path))).drop("_grams")


def fit(
    labelled: DataFrame, host: str = "host", path: str = "path", label: str = "label",
    limit: int = LABELLED_ROWS,
) -> LogisticRegressionModel | None:
    """Fit on a table of hosts, paths and labels (1: block, 0: allow).

    At most ``limit`` distinct rows are used, those with the smallest hashes; null labels are left out.
    """
    taken = (
        labelled.select(
            F.col(host).alias("host"), F.col(path).alias("path"),
            F.col(label).cast("double").alias("label"),
        )
        .where(F.col("label").isNotNull())
        .distinct()
        .orderBy(F.xxhash64("host", "path"), "host", "path", "label")
        .limit(limit)
        .coalesce(1)
    )
    vectors = _vectors(taken, F.col("host"), F.col("path")).cache()
    try:
        if vectors.isEmpty():
            return None
        learner = LogisticRegression(featuresCol="_vector", maxIter=60, regParam=0.01)
        return learner.fit(vectors)
    finally:
        vectors.unpersist()


def judge(
    df: DataFrame, known: list[Rule], model: LogisticRegressionModel | None,
    key: str = "page_id", url: str = "url",
) -> DataFrame:
    """The key column, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` of every row.

    ``score`` is the model's probability that the URL is to be blocked, also where a rule decides.
    """
    cut = df.select(F.col(key).alias("_key"), F.col(url).alias("_url")).select(
        "_key", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path")
    )
    found = cut.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), known))
    if model is None:
        scored = found.withColumn("score", F.lit(0.0))
    else:
        scored = model.transform(_vectors(found, F.col("host"), F.col("path"))).withColumn(
            "score", vector_to_array("probability")[1]
        )
    by_model = F.when(F.col("score") > 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.select(
        F.col("_key").alias(key), "host", "path", F.col("_rule.text").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), by_model).alias("verdict"), "score",
    )
