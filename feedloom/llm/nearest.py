"""Approximate nearest neighbours by cross-polytope hashing, with exact distances in the end.

Vectors are scaled to unit length for hashing only. A table turns them by a pseudo-rotation (three
rounds of random signs and a fast Hadamard transform) and assigns each to the nearest signed axis, its
bucket. A query looks into the ``probes`` buckets whose axes are nearest to it, in every table. What it
finds is ranked by Euclidean distance between the original vectors, in double precision.

A bucket is dealt into parts of bounded size, and a query goes to all parts of its buckets, so a vector
that very many rows share does not meet in one task. Nothing is cut off: every row of a probed bucket is
compared.

A query whose buckets hold fewer than ``k`` rows, as in a small table or far from a tight cluster, is
compared with all rows instead, dealt into blocks of bounded size.

Null vectors, zero vectors and vectors with null or non-finite components take no part, neither as queries
nor as candidates. Vectors of different lengths have no distance: each length is a space of its own. Rows
that repeat an id and its vector count once; a query is not its own neighbour, nor are other rows with its
id. With fewer candidates than ``k``, all are returned; an empty table gives no rows. Equal distances are
ranked by id. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.tables import stored

TABLES = 16
PROBES = 8
PART_ROWS = 8_000
ROUNDS = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of every row, scaled to keep lengths; the width is a power of 2."""
    n, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(n, width // (2 * step), 2, step)
        x = np.concatenate(
            [pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2
        ).reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


def rotated(vectors: np.ndarray, table: int) -> np.ndarray:
    """Unit vectors, padded to a power of two, under the table's pseudo-rotation."""
    n, width = vectors.shape
    padded = np.zeros((n, 1 << max(0, width - 1).bit_length()))
    # Scaling by the largest component first keeps squares of large components finite.
    top = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / top
    padded[:, :width] = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    signs = np.random.default_rng(1000 + table).choice([-1.0, 1.0], (ROUNDS, padded.shape[1]))
    for row in signs:
        padded = hadamard(padded * row)
    return padded


def axes(turned: np.ndarray, most: int) -> np.ndarray:
    """For each row the ``most`` nearest signed axes, nearest first; axis i is +i, n + i is -i."""
    signed = np.concatenate([turned, -turned], axis=1)
    if most == 1:
        return signed.argmax(axis=1)[:, None]
    return np.argsort(-signed, axis=1, kind="stable")[:, :most]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array, np.ndarray, pa.Array]]:
    """Rows (id, vector) of a batch by the length of their vectors: length, ids, matrix, raw vectors."""
    lengths = pc.list_value_length(batch.column(1)).to_numpy()
    for length in np.unique(lengths).tolist():
        rows = pa.array(np.flatnonzero(lengths == length))
        flat = batch.column(1).take(rows).flatten().to_numpy(zero_copy_only=False)
        vectors = flat.astype(np.float64).reshape(-1, length)
        raw = pa.array([v.tobytes() for v in vectors], pa.binary())
        yield length, batch.column(0).take(rows), vectors, raw


def _bucketed(tables: int, probes: int):
    """Rows (id, vector) into (dims, table, bucket, id, vector) for the nearest axes in each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, ids, vectors, raw in _by_length(batch):
                for table in range(tables):
                    buckets = axes(rotated(vectors, table), probes)
                    n, wide = buckets.shape
                    rows = pa.array(np.repeat(np.arange(n), wide))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n * wide, length, np.int32)),
                         pa.array(np.full(n * wide, table, np.int32)),
                         pa.array(buckets.ravel().astype(np.int32)), ids.take(rows), raw.take(rows)],
                        ["dims", "table", "bucket", "id", "vector"],
                    )

    return run


def _raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, vector) into (dims, id, vector)."""
    for batch in batches:
        for length, ids, _, raw in _by_length(batch):
            dims = pa.array(np.full(len(ids), length, np.int32))
            yield pa.RecordBatch.from_arrays([dims, ids, raw], ["dims", "id", "vector"])


def distances(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.sqrt(((others - query) ** 2).sum(axis=1))


def _nearest(k: int):
    """One part of a bucket and the queries that look into it into each query's nearest rows."""

    def run(table: pa.Table) -> pa.Table:
        asks = np.array(table.column("asks").to_pylist())
        ids = table.column("id").to_numpy()
        vectors = np.array(
            [np.frombuffer(v, np.float64) for v in table.column("vector").to_pylist()]
        )
        held, held_ids = vectors[~asks], ids[~asks]
        norms = (held**2).sum(axis=1)
        out: list[list[np.ndarray]] = [[], [], []]
        for query, name in zip(vectors[asks], ids[asks]) if len(held) else ():
            near = norms - 2 * (held @ query)
            near[held_ids == name] = np.inf
            if len(near) > k:
                # Rounding may swap close ones; all that could be among the first k are kept.
                slack = 1e-9 * (1 + norms.max() + query @ query)
                pick = np.flatnonzero(near <= np.partition(near, k - 1)[k - 1] + slack)
            else:
                pick = np.arange(len(near))
            pick = pick[held_ids[pick] != name]
            score = distances(query, held[pick])
            best = np.lexsort((held_ids[pick], score))
            # The same row may stand in the bucket twice.
            _, first = np.unique(held_ids[pick][best], return_index=True)
            best = best[np.sort(first)][:k]
            out[0].append(np.full(len(best), name))
            out[1].append(held_ids[pick][best])
            out[2].append(score[best])
        join = lambda parts, kind: np.concatenate([*parts, np.zeros(0, kind)])
        return pa.table(
            {
                "query_id": pa.array(join(out[0], np.int64).astype(np.int64)),
                "vec_id": pa.array(join(out[1], np.int64).astype(np.int64)),
                "score": pa.array(join(out[2], np.float64)),
            }
        )

    return run


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, vector)`` of the rows that take part."""
    finite = F.forall(
        F.col("vector"),
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)),
    )
    return vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & finite
        & F.exists("vector", lambda x: x != 0)
    )


def search(
    vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10,
    tables: int = TABLES, probes: int = PROBES, part_rows: int = PART_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` nearest rows that were found.

    ``is_query`` says of a row, by its columns, whether it is a query; candidates are all rows.
    """
    rows, queries = usable(vectors, key, vector), usable(vectors.where(is_query), key, vector)
    schema, bucket = "dims int, table int, bucket int, id long, vector binary", ["dims", "table", "bucket"]
    index = rows.mapInArrow(_bucketed(tables, 1), schema)
    asked = queries.mapInArrow(_bucketed(tables, probes), schema)
    found = stored(_compared(index, asked, bucket, k, part_rows), "near")

    enough = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    raw = "dims int, id long, vector binary"
    short = stored(
        queries.mapInArrow(_raw, raw).join(
            enough.select(F.col("query_id").alias("id")), "id", "left_anti"
        ).select("dims", "id", "vector"),
        "short",
    )
    if not short.isEmpty():
        whole = rows.mapInArrow(_raw, raw).join(short.select("dims").distinct(), "dims", "left_semi")
        found = found.unionByName(_compared(whole, short, ["dims"], k, part_rows))
        found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    in_order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(in_order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _compared(
    rows: DataFrame, asked: DataFrame, place: list[str], k: int, part_rows: int
) -> DataFrame:
    """``(query_id, vec_id, score)``: of the rows in each query's places the nearest ones.

    A place is dealt into parts of about ``part_rows`` rows, and a query goes to all of them.
    """
    parts = rows.groupBy(*place).agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts"))
    held = rows.join(parts, place).select(
        *place, F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"),
        F.lit(False).alias("asks"), "id", "vector",
    )
    dealt = asked.join(parts, place).select(
        *place, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(True).alias("asks"), "id", "vector",
    )
    return (
        held.union(dealt)
        .groupBy(*place, "part")
        .applyInArrow(_nearest(k), "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
    )
