"""Language identification with a byte-level convolutional network, trained and applied in numpy.

A text is cut into windows of fixed length that cover all of its bytes. Bytes are embedded, filters of
several widths run over each window, every filter keeps its maximum, and a softmax layer scores the
languages. The probabilities of a text are the mean over its windows.

Training takes a bounded sample: for each language the ``per_language`` rows with the smallest hashes
of their key, and from each at most ``windows_per_text`` windows spread over the text. The network's
size does not depend on the data.

Null texts and texts without a letter are ``und`` with score 0; so is everything when there is nothing
to learn from. Rows are independent; repeated rows, nulls and further columns do not matter, only the
key, text and (in training) language columns are read. Equal probabilities go to the language that
sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from feedloom.llm.arrays import chunks, owners
from feedloom.llm.tables import stored

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 8
UNDETERMINED = "und"
LETTER = r"\p{L}"
WINDOWS_AT_A_TIME = 256


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256 x E; byte 0, the padding, stays at zero
    filters: np.ndarray  # (max width * E) x all filters, zero beyond a filter's width
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def _columns(self, windows: np.ndarray) -> np.ndarray:
        """Embedded bytes of every place and of those after it, n x places x (width * E)."""
        width = max(WIDTHS)
        padded = np.pad(windows, ((0, 0), (0, width - 1)))
        e = self.embedding[padded]
        places = windows.shape[1]
        return np.concatenate([e[:, k : k + places] for k in range(width)], axis=2)

    def forward(self, windows: np.ndarray, learn: bool = False):
        columns = self._columns(windows)
        n, places, depth = columns.shape
        raw = (columns.reshape(-1, depth) @ self.filters).reshape(n, places, -1)
        top = raw.max(axis=1)
        hidden = np.maximum(top + self.bias, 0)
        logits = hidden @ self.dense + self.dense_bias
        logits -= logits.max(axis=1, keepdims=True)
        odds = np.exp(logits)
        odds /= odds.sum(axis=1, keepdims=True)
        return (odds, hidden, raw.argmax(axis=1), columns) if learn else odds

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        parts = [
            self.forward(windows[i : i + WINDOWS_AT_A_TIME])
            for i in range(0, len(windows), WINDOWS_AT_A_TIME)
        ]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)), np.float32)


def cut(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that cover all bytes of every row, and the bounds of each row's windows.

    The last window of a long row is moved back to end with it; short rows are padded with zeros.
    """
    sizes = np.diff(bounds)
    counts = -(-sizes // WINDOW)
    ends = np.concatenate([[0], np.cumsum(counts)])
    row = owners(ends)
    start = bounds[row] + (np.arange(len(row)) - ends[row]) * WINDOW
    start = np.maximum(bounds[row], np.minimum(start, bounds[row + 1] - WINDOW))
    at = start[:, None] + np.arange(WINDOW)
    inside = at < bounds[row + 1][:, None]
    windows = np.where(inside, data[np.minimum(at, len(data) - 1)], 0) if len(row) else at
    return windows.astype(np.uint8), ends


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 4) -> Network:
    """Minimise cross entropy by Adam; the seed is fixed, so equal samples give equal networks."""
    rng = np.random.default_rng(11)
    width, n_filters = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((width, EMBEDDING, n_filters), np.float32)
    for i, w in enumerate(WIDTHS):
        mask[:w, :, i * FILTERS : (i + 1) * FILTERS] = 1
    mask = mask.reshape(-1, n_filters)
    draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    net = Network(
        languages,
        draw(256, EMBEDDING, scale=0.5),
        draw(width * EMBEDDING, n_filters, scale=0.25) * mask,
        np.zeros(n_filters, np.float32),
        draw(n_filters, len(languages), scale=0.2),
        np.zeros(len(languages), np.float32),
    )
    net.embedding[0] = 0
    parameters = [net.embedding, net.filters, net.bias, net.dense, net.dense_bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), 64):
            pick = order[at : at + 64]
            odds, hidden, where, columns = net.forward(windows[pick], learn=True)
            n = len(pick)
            slope = odds.copy()
            slope[np.arange(n), labels[pick]] -= 1
            slope /= n
            back = (slope @ net.dense.T) * (hidden > 0)
            # Only the place where a filter had its maximum passes a gradient.
            rows = np.arange(n)[:, None]
            best = columns[rows, where]  # n x filters x depth
            g_filters = np.einsum("nf,nfd->df", back, best) * mask
            g_columns = back[:, :, None] * net.filters.T[None]
            g_embedding = np.zeros_like(net.embedding)
            padded = np.pad(windows[pick], ((0, 0), (0, width - 1)))
            for k in range(width):
                part = g_columns[:, :, k * EMBEDDING : (k + 1) * EMBEDDING]
                np.add.at(g_embedding, padded[rows, where + k], part)
            g_embedding[0] = 0
            grads = [
                g_embedding, g_filters, back.sum(axis=0), hidden.T @ slope, slope.sum(axis=0),
            ]
            step += 1
            for p, g, (m, v) in zip(parameters, grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def fit(
    df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = 600, windows_per_text: int = 3,
) -> Network | None:
    """A network learnt from the rows with a text and a language; None without any."""
    rank = Window.partitionBy("lang").orderBy("order", "key")
    usable = (
        df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
        .where(F.col("lang").isNotNull() & F.col("text").rlike(LETTER))
        .withColumn("order", F.xxhash64("key", "text"))
    )
    # Texts stay where they are; only keys are ranked.
    chosen = stored(
        usable.select("lang", "key", "order")
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= per_language),
        "language-sample",
    )
    same = [usable[c].eqNullSafe(chosen[c]) for c in ("lang", "key", "order")]
    rows = (
        usable.join(chosen, same)
        .select(usable["lang"], "text", "rank")
        .mapInArrow(
            lambda batches: _windows_of(batches, windows_per_text),
            "lang string, rank int, part int, bytes binary",
        )
        .distinct()
        .orderBy("lang", "rank", "part")
        .collect()
    )
    if not rows:
        return None
    languages = sorted({r.lang for r in rows})
    windows = np.frombuffer(b"".join(bytes(r.bytes) for r in rows), np.uint8).reshape(-1, WINDOW)
    place = {name: i for i, name in enumerate(languages)}
    return train(windows, np.array([place[r.lang] for r in rows]), languages)


def _windows_of(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Up to ``most`` windows of every text, spread evenly over it."""
    for batch in batches:
        out: list[list] = [[], [], [], []]
        langs, ranks = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for chunk in chunks(batch.column(1)):
            windows, ends = cut(chunk.data, chunk.bounds)
            for row in range(chunk.last - chunk.first):
                n = ends[row + 1] - ends[row]
                for part, i in enumerate(sorted({k * n // most for k in range(most)})):
                    values = langs[chunk.first + row], ranks[chunk.first + row], part
                    for column, value in zip(out, (*values, windows[ends[row] + i].tobytes())):
                        column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()),
             pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary())],
            ["lang", "rank", "part", "bytes"],
        )


def predict(
    df: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """The key column (or the columns in ``keep``), ``lang_pred`` and ``score`` for every row."""
    keep = keep or [key]
    schema = StructType(
        [StructField(f"_{i}", df.schema[name].dataType) for i, name in enumerate(keep)]
        + [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lettered = batch.column(0), batch.column(1).to_pylist()
            langs: list[str] = [UNDETERMINED] * batch.num_rows
            scores = np.zeros(batch.num_rows)
            for chunk in chunks(texts, 1 << 18) if network else ():
                windows, ends = cut(chunk.data, chunk.bounds)
                sums = np.concatenate([
                    np.zeros((1, len(network.languages))),
                    np.cumsum(network.probabilities(windows), axis=0, dtype=np.float64),
                ])
                odds = sums[ends[1:]] - sums[ends[:-1]]
                odds /= np.maximum(1, np.diff(ends))[:, None]
                best = odds.argmax(axis=1)
                for row in range(chunk.last - chunk.first):
                    if lettered[chunk.first + row]:
                        langs[chunk.first + row] = network.languages[best[row]]
                        scores[chunk.first + row] = min(1.0, odds[row, best[row]])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array(langs, pa.string()), pa.array(scores)],
                schema.names,
            )

    lettered = F.coalesce(F.col(text).rlike(LETTER), F.lit(False))
    picked = df.select(
        F.col(text).alias("_text"), lettered.alias("_lettered"),
        *[F.col(name).alias(f"_{i}") for i, name in enumerate(keep)],
    )
    return picked.mapInArrow(run, schema).toDF(*keep, "lang_pred", "score")
