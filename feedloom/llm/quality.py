"""Quality scores from positive-unlabelled learning.

The learner sees trusted positives (rows marked good) and unlabelled web text; it never sees a row
marked bad. With the class prior ``p`` of good text among unlabelled text, the risk of a scorer ``g`` is

    p * E_good[loss(g, good)] + max(0, E_unlabelled[loss(g, bad)] - p * E_good[loss(g, bad)])

whose second term estimates the risk on bad text. Where its estimate falls below zero on a batch, the
step is reversed for that term, so the scorer cannot gain by fitting the unlabelled rows (Kiryo et al.
2017). The scorer is a small network over statistics of the whole text, trained by Adam in numpy.

The prior is estimated from the sample: a first pass with a middle prior ranks the rows, and then for
each threshold the share of unlabelled rows below it over the share of positives below it bounds the
prior from above (Elkan and Noto 2008; Scott 2015); the lowest bound with enough rows is taken.

Training reads a bounded sample: the ``sample`` positives and the ``sample`` unlabelled rows with the
smallest hashes of their key. Null and empty texts have the statistics of an empty text and are scored
like any other. Without positives or unlabelled rows every score is 0.5. Rows are independent; only the
key and text columns are read, so repeated rows, nulls and further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField, StructType

from feedloom.llm.arrays import SPACES, chunks, owners, rolling, word_codes, words

LINE_BREAKS = np.zeros(256, bool)
LINE_BREAKS[10] = True

FEATURES = (
    "log_bytes", "log_words", "word_length", "word_spread", "upper", "digits", "spaces", "breaks",
    "letters", "non_ascii", "sentence_ends", "commas", "marks", "brackets", "quotes", "slashes",
    "other_signs", "same_byte_runs", "lone_signs", "distinct_words", "repeated_pairs",
    "repeated_lines", "short_lines", "line_length", "capital_words", "digit_words", "word_entropy",
    "longest_word",
)


def _class(*items) -> np.ndarray:
    table = np.zeros(256, np.float32)
    for item in items:
        table[item] = 1
    return table


_LETTERS = _class(slice(65, 91), slice(97, 123), slice(128, 256))
_UPPER, _DIGITS = _class(slice(65, 91)), _class(slice(48, 58))
_BYTE_CLASSES = np.stack(
    [
        _UPPER, _DIGITS, _class(32), _class(10), _LETTERS, _class(slice(128, 256)),
        _class(list(b".?")), _class(list(b",;:")), _class(list(b"!")), _class(list(b"()[]{}<>")),
        _class(list(b"\"'`")), _class(list(b"/\\|")), _class(list(b"#$%&*+-=@^_~")),
    ]
)


def features(texts: pa.Array) -> np.ndarray:
    """Statistics of every whole text, one row each; see FEATURES."""
    return np.concatenate(
        [_features(chunk) for chunk in chunks(texts)] or [np.zeros((0, len(FEATURES)), np.float32)]
    )


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _distinct(codes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of each row, and the entropy of their counts."""
    if not len(codes):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((codes, row))
    codes, row = codes[order], row[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(codes)))
    owner = row[first]
    total = np.bincount(row, minlength=n)
    share = counts / total[owner]
    return (
        np.bincount(owner, minlength=n).astype(float),
        np.bincount(owner, weights=-share * np.log(share), minlength=n),
    )


def _features(chunk) -> np.ndarray:
    data, bounds = chunk.data, chunk.bounds
    n, size = len(bounds) - 1, np.maximum(1, np.diff(bounds))
    found = words(chunk)
    count = np.diff(found.bounds)
    some = np.maximum(1, count)
    width = (found.stop - found.start).astype(float)
    row = owners(found.bounds)
    codes = word_codes(chunk, found, fold=True)
    distinct, entropy = _distinct(codes, row, n)
    pairs = codes[:-1] * np.uint64(3) + codes[1:]
    inner = row[:-1] == row[1:] if len(row) else np.zeros(0, bool)
    distinct_pairs, _ = _distinct(pairs[inner], row[:-1][inner], n)
    lines = words(chunk, LINE_BREAKS)
    line_row = owners(lines.bounds)
    line_count = np.maximum(1, np.diff(lines.bounds))
    line_codes = rolling(np.arange(1, 257, dtype=np.uint64)[data]).hashes(lines.start, lines.stop)
    distinct_lines, _ = _distinct(line_codes, line_row, n)
    line_width = lines.stop - lines.start
    mean_width = _sums(width, found.bounds) / some
    same = np.zeros(len(data))
    same[1:] = (data[1:] == data[:-1]) & ~_LETTERS[data[1:]].astype(bool)
    first_byte = data[found.start]
    lone = (width == 1) & ~(_LETTERS + _DIGITS)[first_byte].astype(bool)
    longest = np.zeros(n)
    np.maximum.at(longest, row, width)
    columns = [
        np.log1p(np.diff(bounds)), np.log1p(count), mean_width,
        np.sqrt(np.maximum(0, _sums(width**2, found.bounds) / some - mean_width**2)),
        *(_sums(table[data], bounds) / size for table in _BYTE_CLASSES),
        _sums(same, bounds) / size, _sums(lone, found.bounds) / some, distinct / some,
        1 - (distinct_pairs + 1) / some, 1 - distinct_lines / line_count,
        _sums(line_width < 20, lines.bounds) / line_count,
        np.log1p(_sums(line_width, lines.bounds) / line_count),
        _sums(_UPPER[first_byte], found.bounds) / some,
        _sums(_DIGITS[first_byte], found.bounds) / some,
        entropy / np.log(np.maximum(2, count)), np.log1p(longest),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


@dataclass
class Scorer:
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    prior: float

    def hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return z, np.maximum(z @ self.layers[0] + self.layers[1], 0)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x)[1] @ self.layers[2] + self.layers[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x).astype(np.float64), -30, 30)))


def train(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 1500, units: int = 24
) -> Scorer:
    """Minimise the non-negative risk with the logistic loss; the seed is fixed."""
    rng = np.random.default_rng(5)
    both = np.concatenate([positive, unlabelled])
    net = Scorer(
        both.mean(axis=0), both.std(axis=0) + 1e-6,
        [rng.normal(0, (2 / both.shape[1]) ** 0.5, (both.shape[1], units)).astype(np.float32),
         np.zeros(units, np.float32), rng.normal(0, 0.2, units).astype(np.float32),
         np.zeros(1, np.float32)],
        prior,
    )
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.layers]
    sigmoid = lambda v: 1 / (1 + np.exp(-np.clip(v, -30, 30)))
    size = 256
    for step in range(1, steps + 1):
        x = np.concatenate(
            [positive[rng.integers(0, len(positive), size)],
             unlabelled[rng.integers(0, len(unlabelled), size)]]
        )
        z, hidden = net.hidden(x)
        g = hidden @ net.layers[2] + net.layers[3]
        good, web = g[:size], g[size:]
        # loss(g, good) = log(1 + exp(-g)), loss(g, bad) = log(1 + exp(g))
        bad_risk = np.logaddexp(0, web).mean() - prior * np.logaddexp(0, good).mean()
        d_bad = np.concatenate([-prior * sigmoid(good), sigmoid(web)]) / size
        d_good = np.concatenate([-prior * sigmoid(-good), np.zeros(size)]) / size
        slope = d_good + d_bad if bad_risk >= 0 else -d_bad
        back = np.outer(slope, net.layers[2]) * (hidden > 0)
        grads = [z.T @ back, back.sum(axis=0), hidden.T @ slope, np.array([slope.sum()])]
        for p, d, (m, v) in zip(net.layers, grads, moments):
            d = d.astype(np.float32) + 1e-4 * p
            m += 0.1 * (d - m)
            v += 0.001 * (d * d - v)
            p -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of good text among the unlabelled, bounded from scores of held-back positives."""
    half = len(positive) // 2
    net = train(positive[:half], unlabelled, 0.5, steps=600)
    good, web = net.raw(positive[half:]), np.sort(net.raw(unlabelled))
    levels = np.unique(np.quantile(good, np.linspace(0.02, 1, 50)))
    above_good = np.array([(good >= t).mean() for t in levels])
    above_web = 1 - np.searchsorted(web, levels) / len(web)
    # One standard error on both shares keeps a chance low from being taken for the prior.
    error = np.sqrt(1 / np.maximum(1, above_good * len(good)))
    bounds = above_web * (1 + error) / np.maximum(above_good, 1e-9)
    return float(np.clip(bounds[above_good > 0.05].min(initial=0.98), 0.05, 0.98))


def fit(
    df: DataFrame, marks: DataFrame, positive: str, usable: str, key: str = "doc_id",
    text: str = "text", sample: int = 6000,
) -> Scorer | None:
    """A scorer learnt from marked rows of ``df``.

    ``marks`` has the key and two boolean columns: ``positive`` for trusted positives, ``usable`` for
    rows that count as unlabelled unless they are positives. Only keys are sorted for the sample of at
    most ``sample`` of each; their texts are fetched where they lie. A key that several rows repeat
    counts once, with the least statistics of its texts.
    """
    good, usable = (F.coalesce(F.col(c), F.lit(False)) for c in (positive, usable))
    known = marks.select(F.col(key).alias("key"), good.alias("good"), usable.alias("usable"))
    texts = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def collected(rows: DataFrame) -> np.ndarray:
        keys = rows.select("key").distinct().orderBy(F.xxhash64("key"), "key").limit(sample)
        taken = texts.join(F.broadcast(keys), "key")
        # One row for a key, however many rows repeat it.
        each = statistics(taken, "key", "text").groupBy("key").agg(F.min("features").alias("features"))
        found = each.orderBy("key").collect()
        return np.array([r.features for r in found], np.float32).reshape(-1, len(FEATURES))

    positives = collected(known.where("good"))
    web = collected(known.where("usable AND NOT good"))
    if len(positives) < 2 or not len(web):
        return None
    # Sorted keys are in no way random, halves of the sample have to be.
    positives = np.random.default_rng(3).permutation(positives)
    return train(positives, web, estimate_prior(positives, web))


def statistics(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key column and the statistics of every row's text as ``features``."""
    schema = StructType(
        [StructField("_key", df.schema[key].dataType),
         StructField("features", ArrayType(FloatType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = features(batch.column(1))
            bounds = np.arange(len(found) + 1, dtype=np.int32) * len(FEATURES)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["_key", "features"])

    picked = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return picked.mapInArrow(run, schema).withColumnRenamed("_key", key)


def score(
    df: DataFrame, scorer: Scorer | None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The key column and ``score``, between 0 and 1, for every row."""
    schema = StructType(
        [StructField("_key", df.schema[key].dataType), StructField("score", DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if scorer is None:
                scores = np.full(batch.num_rows, 0.5)
            else:
                scores = scorer.score(features(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["_key", "score"])

    picked = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return picked.mapInArrow(run, schema).withColumnRenamed("_key", key)
