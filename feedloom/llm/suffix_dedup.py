"""Removal of repeated byte strings with suffix arrays.

A string of 50 bytes is repeated when it also starts in a document with a smaller key; every byte inside
a repeated string is removed. Texts count as UTF-8 bytes, so what is left need not be valid UTF-8.
``repeats`` finds the passages that may repeat and deals them over shards. Each shard sorts the suffixes
of its passages and derives the lengths of common prefixes of neighbours from the Burrows-Wheeler
transform, in increasing order: ranges of suffixes that share a string are extended breadth first by one
byte to the left, and the bounds that appear for the first time in round ``l`` have a common prefix of
``l`` bytes (Beller et al. 2013). The search ends at the minimum length; suffixes without a bound between
them share at least that many bytes, and the smallest document among them is the first to hold them.

Null and empty texts have no bytes. See ``repeats`` for repeated rows, null keys and further columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from feedloom.llm import repeats
from feedloom.llm.arrays import chunks, expand

LENGTH = 50


def short_prefix_bounds(transform: np.ndarray, length: int) -> np.ndarray:
    """Whether sorted suffixes i - 1 and i share fewer than ``length`` symbols, for i from 0 to n.

    ``transform`` holds the symbol before each suffix, in the suffixes' order.
    """
    n = len(transform)
    by_symbol = np.argsort(transform, kind="stable")
    step = np.empty(n, np.int64)  # where a suffix goes when its left symbol is put before it
    step[by_symbol] = np.arange(n)
    head = transform[by_symbol]
    bound = np.zeros(n + 1, bool)
    bound[[0, n]] = True
    low, high = np.array([0]), np.array([n])
    owner = np.full(n + 1, -1, np.int64)
    number = 0
    for _ in range(length):
        if not len(low):
            break
        sizes = high - low
        own = np.repeat(np.arange(number, number + len(low)), sizes)
        number += len(low)
        to = step[expand(low, sizes)]
        owner[to] = own
        # Ranges that go on with the same symbol: runs of one owner and one head.
        after = to + 1
        inside = after < n
        last = np.ones(len(to), bool)
        last[inside] = (owner[after[inside]] != own[inside]) | (
            head[after[inside]] != head[to[inside]]
        )
        before = to - 1
        inside = before >= 0
        first = np.ones(len(to), bool)
        first[inside] = (owner[before[inside]] != own[inside]) | (
            head[before[inside]] != head[to[inside]]
        )
        low, high = np.sort(to[first]), np.sort(after[last])
        new = ~bound[high]
        low, high = low[new], high[new]
        bound[high] = True
    return bound


def search(symbols: np.ndarray, bounds: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For every byte of the passages, whether a repeated string starts there."""
    n, sizes = len(bounds) - 1, np.diff(bounds)
    # Every passage ends with a mark of its own, below all bytes.
    at = np.arange(len(symbols)) + np.repeat(np.arange(n), sizes)
    text = np.empty(len(symbols) + n, np.int64)
    text[at] = symbols.astype(np.int64) + n
    text[bounds[1:] + np.arange(n)] = np.arange(n)
    order = repeats.suffix_order(text)
    bound = short_prefix_bounds(text[order - 1], LENGTH)[:-1]
    owner = np.repeat(np.arange(n), sizes + 1)
    suffix_doc = doc[owner[order]]
    first = np.flatnonzero(bound)
    least = np.minimum.reduceat(suffix_doc, first)[np.cumsum(bound) - 1]
    late = np.zeros(len(text), bool)
    late[order] = suffix_doc > least
    hit = late[at]
    # A string has to end inside its passage.
    return hit & (np.arange(len(symbols)) + LENGTH <= np.repeat(bounds[1:], sizes))


def remove_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Every row's key (or the columns in ``keep``), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept``.

    ``kept`` holds the bytes that are left.
    """
    kind = repeats.of_bytes(LENGTH)
    keep = keep or [key]
    found = repeats.with_repeats(df, kind, search, key, text, keep)
    schema = StructType(
        [StructField(f"_{i}", df.schema[c].dataType) for i, c in enumerate(keep)]
        + [StructField("n_bytes", LongType()), StructField("n_removed", LongType()),
           StructField("n_spans", LongType()), StructField("kept", BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column(1).to_pylist()
            counts, kept = [], []
            for chunk in chunks(batch.column(0)):
                raw = chunk.data.tobytes()
                for row, blob in enumerate(blobs[chunk.first : chunk.last]):
                    low, high = int(chunk.bounds[row]), int(chunk.bounds[row + 1])
                    start, stop = repeats.spans_from_bytes(blob or [])
                    edges = [low, *(low + np.stack([start, stop], 1)).ravel().tolist(), high]
                    kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
                    counts.append((high - low, int((stop - start).sum()), len(start)))
            columns = np.array(counts, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], *(pa.array(c) for c in columns), pa.array(kept, pa.binary())],
                schema.names,
            )

    names = ["n_bytes", "n_removed", "n_spans", "kept"]
    return found.mapInArrow(run, schema).toDF(*keep, *names)
