"""Substring deduplication with a compressed full-text index per shard.

A window of 50 words is repeated when an equal one starts in a document with a smaller key; every word
inside a repeated window is removed. ``repeats`` finds the passages that may repeat and deals them over
shards; each shard builds an FM-index of its passages (the Burrows-Wheeler transform in a wavelet
matrix, with the documents of the suffixes) and streams the passages through it. Backward search
yields, for every end of a passage, how far back an earlier document goes along with it. These matching
statistics are counted in blocks of ten words, on the ten phases of a passage, up to the threshold of
five blocks; stretches that reach it are reported.

Null and empty texts have no words. See ``repeats`` for repeated rows, null keys and further columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from feedloom.llm import repeats
from feedloom.llm.arrays import chunks, expand, rolling, words

WINDOW = 50
BLOCK = 10


class WaveletMatrix:
    """Ranks of any symbol in any prefix of a sequence, one bit vector for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.bits = max(1, int(largest).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            counts = np.zeros(len(bit) + 1, np.int32)
            np.cumsum(bit, out=counts[1:])
            self.ones.append(counts)
            self.zeros.append(len(bit) - int(counts[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the first ``at`` symbols end for a symbol in the last level's order."""
        for i, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbol >> (self.bits - 1 - i)) & 1
            one = ones[at]
            at = np.where(bit == 1, zeros + one, at - one)
        return at


class SmallestIn:
    """The smallest value in any range of an array, from minima of ranges of doubling width."""

    def __init__(self, values: np.ndarray):
        self.levels = [values.astype(np.int32)]
        width = 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out = np.empty(len(low), np.int32)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for i in np.unique(level):
            own = level == i
            values = self.levels[i]
            out[own] = np.minimum(values[low[own]], values[high[own] - (1 << int(i))])
        return out


class FullTextIndex:
    """An FM-index of sequences of symbols 0..n-1, which knows the documents they stand in."""

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray, doc: np.ndarray):
        n = len(bounds) - 1
        sizes = np.diff(bounds)
        # Every sequence ends with a mark of its own, below all symbols.
        at = np.arange(len(symbols)) + np.repeat(np.arange(n), sizes)
        text = np.empty(len(symbols) + n, np.int64)
        text[at] = symbols + n
        text[bounds[1:] + np.arange(n)] = np.arange(n)
        order = repeats.suffix_order(text)
        transform = text[order - 1]
        owner = np.repeat(np.arange(n), sizes + 1)[order]
        self.offset = n
        self.earliest = SmallestIn(doc[owner])
        self.matrix = WaveletMatrix(transform, len(text))
        found = np.sort(text)
        self.first = np.searchsorted(found, np.arange(found[-1] + 2))
        every = np.arange(found[-1] + 1)
        self.base = self.matrix.place(every, np.zeros_like(every))
        self.size = len(text)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """The ranges of the sequences that go on with a symbol to the left."""
        symbol = symbol + self.offset
        shift = self.first[symbol] - self.base[symbol]
        return self.matrix.place(symbol, low) + shift, self.matrix.place(symbol, high) + shift

    def matching(self, symbols, bounds, doc, end, most: int) -> np.ndarray:
        """For every end, how many symbols before it an earlier document has too, ``most`` at most.

        ``end`` counts places in ``symbols``; a match stays inside the end's own sequence.
        """
        owner = np.searchsorted(bounds, end, "left") - 1
        floor, limit = bounds[owner], doc[owner]
        low, high = np.zeros(len(end), np.int64), np.full(len(end), self.size, np.int64)
        length = np.zeros(len(end), np.int64)
        active = np.arange(len(end))
        for step in range(1, most + 1):
            active = active[end[active] - step >= floor[active]]
            symbol = symbols[end[active] - step]
            low, high = low[: len(end)], high[: len(end)]
            new_low, new_high = self.extend(symbol, low[active], high[active])
            some = new_high > new_low
            active, new_low, new_high = active[some], new_low[some], new_high[some]
            early = self.earliest(new_low, new_high) < limit[active] if len(active) else some[:0]
            active = active[early]
            low[active], high[active] = new_low[early], new_high[early]
            length[active] = step
        return length


def search(symbols: np.ndarray, bounds: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For every word of the passages, whether a repeated window starts there."""
    ranks = np.unique(doc, return_inverse=True)[1]
    blocks = rolling(symbols).every(BLOCK)
    sizes = np.maximum(0, np.diff(bounds) - BLOCK + 1)
    starts = expand(bounds[:-1], sizes)
    phase = (starts - np.repeat(bounds[:-1], sizes)) % BLOCK
    owner = np.repeat(np.arange(len(sizes)), sizes)
    # A passage's blocks, phase by phase, as one sequence each.
    order = np.lexsort((starts, phase, owner))
    lane = (owner * BLOCK + phase)[order]
    first = np.flatnonzero(np.append(True, lane[1:] != lane[:-1]))
    lane_bounds = np.append(first, len(order))
    numbers = np.unique(blocks[starts[order]], return_inverse=True)[1]
    lane_doc = ranks[owner[order][first]]
    index = FullTextIndex(numbers, lane_bounds, lane_doc)
    need = WINDOW // BLOCK
    # Ends after which a whole window of blocks lies in the lane.
    many = np.maximum(0, np.diff(lane_bounds) - need + 1)
    end = expand(lane_bounds[:-1], many) + need
    length = index.matching(numbers, lane_bounds, lane_doc, end, need)
    hit = np.zeros(len(symbols), bool)
    hit[starts[order[end[length >= need] - need]]] = True
    return hit


def remove_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Every row's key (or the columns in ``keep``), ``n_words``, ``n_removed`` and ``kept``, its words left, joined by spaces."""
    kind = repeats.of_words(WINDOW)
    keep = keep or [key]
    found = repeats.with_repeats(df, kind, search, key, text, keep)
    schema = StructType(
        [StructField(f"_{i}", df.schema[c].dataType) for i, c in enumerate(keep)]
        + [StructField("n_words", LongType()), StructField("n_removed", LongType()),
           StructField("kept", StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column(1).to_pylist()
            n_words, n_removed, kept = [], [], []
            for chunk in chunks(batch.column(0)):
                cut = words(chunk)
                raw = chunk.data.tobytes()
                for row in range(chunk.last - chunk.first):
                    low, high = cut.bounds[row], cut.bounds[row + 1]
                    stay = np.ones(high - low, bool)
                    blob = blobs[chunk.first + row]
                    if blob:
                        for a, b in zip(*repeats.spans_from_bytes(blob)):
                            stay[a:b] = False
                    start, stop = cut.start[low:high][stay], cut.stop[low:high][stay]
                    n_words.append(high - low)
                    n_removed.append(high - low - len(start))
                    parts = [raw[a:b] for a, b in zip(start.tolist(), stop.tolist())]
                    kept.append(b" ".join(parts).decode())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array(n_words, pa.int64()),
                 pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                schema.names,
            )

    return found.mapInArrow(run, schema).toDF(*keep, "n_words", "n_removed", "kept")
