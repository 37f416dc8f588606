"""Exact Jaccard join of documents' word n-grams, as a join in a metric space.

A document's set holds the hashes of its distinct n-grams of words (``[^\\x20\\x09-\\x0D]+``, A-Z in lower
case); with fewer words the whole sequence is the one element, and without words the set is empty and
linked with nothing. ``1 - |A n B| / |A u B|`` is a metric, and two documents are linked when they are
within the radius ``1 - threshold`` of each other.

1. Documents with equal sets form one class; the join is between classes. A class takes part only if its
   documents hold that share of their elements together with others without which nothing can be linked
   to them (``described``). Elements are counted row by row first and then again between the classes that
   are left, so that copies do not keep each other. Chance puts a few elements of most documents into
   others, more of them the larger the corpus is; such documents end here.
2. *Pivots.* Linked sets share an element among the first ``|A| - ceil(threshold |A|) + 1`` of each, in
   any common order of the elements. So every such element gathers the classes it may link, and the
   smallest of them becomes the pivot; the pivot's region holds all classes that any element gave it.
   The common order puts elements last that are frequent in the whole corpus (counted in a table of
   fixed size), so that boilerplate makes no regions.
3. *Coarse join.* Within a region, classes are compared by counts of their elements in hash buckets. The
   bucket counts lie in a metric space too (one minus the sum of minima over the sum of maxima), whose
   distances are never larger, so no link is lost; classes that stay apart there go.
4. *Exact join.* What hangs together coarsely is a cell, and a cell is joined on the sets themselves.

Steps 3 and 4 use the same recursion (``link``): pivots create Voronoi regions; a member also goes into a
neighbouring region if it may have a link into it, that is if it is at most one radius beyond the
region's farthest home member and its distances to both pivots differ by at most two radii; the regions
are joined in the same way until they are small. Members that are linked already need no comparison.
Cells too large for one task take the same steps as Spark jobs (``_split``). Every comparison that decides
about a link is exact, in integers.

Rows are told apart by key and text, so a repeated key does not matter. A row with a null key takes part
in no group; its component is null. Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.arrays import Chunk, chunks, mix, rolling, word_codes, words
from feedloom.llm.components import components
from feedloom.llm.tables import likely, shuffle_partitions, stored

_U = np.uint64
PERCENT = 75
N = 5
COUNTER_BITS = 19
LEAF = 24
PIVOTS = 12
# Beyond these a region is not compared in one task, and a cell is split by Spark jobs.
REGION_MEMBERS = 5_000
CELL_ELEMENTS = 6_000_000
# Bytes of texts taken apart at once; arrays of that many numbers stay in a core's cache.
TEXT_BYTES = 1 << 18
# Elements and rows that are packed together on their way to be counted.
PACKET_ELEMENTS = 1 << 20
PACKET_ROWS = 50_000


# Sets


def sets(chunk: Chunk, n: int = N) -> list[np.ndarray]:
    """The sorted set of every row."""
    found = words(chunk)
    roll = rolling(word_codes(chunk, found, fold=True))
    whole = roll.every(n)
    bounds = found.bounds.tolist()
    for low, high in zip(bounds, bounds[1:]):
        whole[low : max(low, high - n + 1)].sort()
    new = np.append(True, whole[1:] != whole[:-1])
    out = []
    for low, high in zip(bounds, bounds[1:]):
        if high - low >= n:
            new[low] = True
            own = slice(low, high - n + 1)
            out.append(whole[own][new[own]])
        else:
            # The whole sequence, or nothing.
            ends = found.bounds[:0] if high == low else np.array([low, high])
            out.append(roll.hashes(ends[:1], ends[1:]))
    return out


def class_of(elements: np.ndarray) -> int:
    """A hash of a set, as a signed 64-bit number."""
    total = mix(elements).sum(keepdims=True, dtype=_U)
    return int(mix(total + _U(len(elements) * 0xD6E8FEB86659FD93 % 2**64)).view(np.int64)[0])


def bucket_counts(elements: np.ndarray) -> bytes:
    """Counts of elements in 2^level buckets, about four in each; the first byte is the level."""
    level = max(4, (len(elements) // 4).bit_length())
    counts = np.bincount((elements >> _U(64 - level)).astype(np.int64), minlength=1 << level)
    # A count that does not fit makes the row comparable with everything.
    return bytes([level if counts.max() < 256 else 0]) + counts.astype(np.uint8).tobytes()


def prefix(elements: np.ndarray, weight: np.ndarray, percent: int) -> np.ndarray:
    """The elements of which linked sets share one, in the common order."""
    n = len(elements)
    keep = n - -(-percent * n // 100) + 1
    heavy = weight[(elements >> _U(64 - COUNTER_BITS)).astype(np.int64)]
    if not heavy.any():
        return elements[:keep]
    return elements[np.lexsort((elements, heavy))[:keep]]


# The recursion


class Forest:
    """Which members are known to hang together."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    def roots(self, members: np.ndarray) -> np.ndarray:
        parent = self.parent
        out = parent[members]
        while (parent[out] != out).any():
            out = parent[out]
        return out

    def join(self, a: int, others: np.ndarray) -> None:
        low = self.root(a)
        for b in others.tolist():
            other = self.root(b)
            if other != low:
                low, other = min(low, other), max(low, other)
                self.parent[other] = low


class Sets:
    """A space of sets with Jaccard distances."""

    def __init__(self, members: list[np.ndarray], percent: int):
        self.members, self.percent = members, percent
        self.sizes = np.array([len(m) for m in members])

    def compare(self, pivot: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances to the others, and which of them are linked."""
        own = self.members[pivot]
        sizes = self.sizes[others]
        every = np.concatenate([self.members[i] for i in others])
        at = np.searchsorted(own, every)
        at[at == len(own)] = 0
        same = np.add.reduceat(own[at] == every, np.cumsum(sizes) - sizes).astype(np.int64)
        union = sizes + len(own) - same
        return 1 - same / union, 100 * same >= self.percent * union


class Counts:
    """A space of bucket counts, whose distances are at most those of the sets."""

    def __init__(self, counts: np.ndarray, percent: int):
        self.counts, self.percent = counts, percent
        self.sizes = counts.sum(axis=1, dtype=np.int64)

    def compare(self, pivot: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = self.counts[others]
        low = np.minimum(rows, self.counts[pivot]).sum(axis=1, dtype=np.int64)
        high = self.sizes[others] + self.sizes[pivot] - low
        return 1 - low / high, 100 * low >= self.percent * high


def windows(distances: np.ndarray, radius: float) -> list[np.ndarray]:
    """For each pivot (a row of distances) the members of its region, at home there or replicated."""
    home, own = distances.argmin(axis=0), distances.min(axis=0)
    out = []
    for i, d in enumerate(distances):
        at_home = home == i
        reach = own[at_home].max(initial=-1.0)
        inside = (d <= own + 2 * radius + 1e-9) & (d <= reach + radius + 1e-9)
        out.append(np.flatnonzero(at_home | inside) if at_home.any() else np.zeros(0, np.int64))
    return out


def link(space: Sets | Counts, members: np.ndarray, forest: Forest) -> None:
    """Join all linked members in the forest."""
    radius = 1 - space.percent / 100
    regions = [members]
    while regions:
        region = regions.pop()
        roots = forest.roots(region)
        if (roots == roots[0]).all():
            continue
        if len(region) <= LEAF:
            _compare_all(space, region, forest)
            continue
        region = region[np.argsort(space.sizes[region], kind="stable")]
        chosen = np.linspace(0, len(region) - 1, PIVOTS).astype(np.int64)
        rows = []
        for at in chosen:
            distances, linked = space.compare(region[at], region)
            forest.join(region[at], region[linked])
            rows.append(distances)
        # Pivots have met everyone.
        rest = np.setdiff1d(np.arange(len(region)), chosen)
        distances = np.stack(rows)[:, rest]
        for i, inside in enumerate(windows(distances, radius)):
            part = region[rest[inside]]
            if len(part) < 2:
                continue
            if len(part) <= 0.7 * len(region):
                regions.append(part)
            else:
                _compare_near(space, part, distances[i][inside], radius, forest)


def _compare_all(space, region: np.ndarray, forest: Forest) -> None:
    for i in range(len(region) - 1):
        others = region[i + 1 :]
        others = others[forest.roots(others) != forest.root(region[i])]
        if len(others):
            forest.join(region[i], others[space.compare(region[i], others)[1]])


def _compare_near(space, region, distances, radius: float, forest: Forest) -> None:
    """For a region that pivots do not divide: only members at about the same distance can be linked."""
    order = np.argsort(distances, kind="stable")
    region, distances = region[order], distances[order]
    last = np.searchsorted(distances, distances + radius + 1e-9, "right")
    for i in range(len(region) - 1):
        others = region[i + 1 : last[i]]
        others = others[forest.roots(others) != forest.root(region[i])]
        if len(others):
            forest.join(region[i], others[space.compare(region[i], others)[1]])


# The steps as Spark jobs


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).alias("key"), F.col(text).alias("text"))


def element_weights(texts: DataFrame) -> np.ndarray:
    """How often elements occur in the corpus, by hash bucket; zero where that is not unusual."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTER_BITS, np.int64)
        for batch in batches:
            for chunk in chunks(batch.column(0), TEXT_BYTES):
                own = np.concatenate([*sets(chunk), np.zeros(0, _U)])
                places = (own >> _U(64 - COUNTER_BITS)).astype(np.int64)
                total += np.bincount(places, minlength=len(total))
        parts = np.split(total.astype("<u4"), 16)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(16), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
            ["part", "counts"],
        )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros((1 << COUNTER_BITS) // 16, np.uint64)
        for blob in table.column("counts").to_pylist():
            total += np.frombuffer(blob, "<u4")
        return pa.table(
            {
                "part": table.column("part").slice(0, 1),
                "counts": pa.array([total.tobytes()], pa.binary()),
            }
        )

    schema = "part int, counts binary"
    rows = texts.mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect()
    total = np.zeros(1 << COUNTER_BITS, np.int64)
    size = len(total) // 16
    for row in rows:
        total[row.part * size : (row.part + 1) * size] = np.frombuffer(bytes(row.counts), "<u8")
    return np.where(total > 2 * total.mean() + 8, total, 0).astype(np.uint32)


# A packet's elements for one shard: 32 bits of each, then the low and the high bytes of its row.


def _packet(number: int, batches: list, own: list[np.ndarray], shards: int) -> pa.RecordBatch:
    """Rows as ``(shard, packet, directory, elements)``: once as they are, and their elements by shard."""
    directory = pa.Table.from_batches(batches).combine_chunks()
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, directory.schema) as writer:
        writer.write_table(directory)
    elements = np.concatenate([*own, np.zeros(0, _U)])
    row = np.repeat(np.arange(len(own)), [len(s) for s in own]).astype("<u2")
    shard = ((elements >> _U(32)) % _U(shards)).astype(np.uint16 if shards < 1 << 16 else np.uint32)
    order = np.argsort(shard, kind="stable")
    values, row = elements[order].astype("<u4"), row[order].view(np.uint8).reshape(-1, 2)
    named, first = np.unique(shard[order], return_index=True)
    ends = [*first[1:].tolist(), len(order)]
    blobs = [
        values[low:high].tobytes() + row[low:high].T.tobytes() for low, high in zip(first, ends)
    ]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number % shards, *named.tolist()], pa.int32()),
            pa.array([number] * (1 + len(blobs)), pa.int64()),
            pa.array([out.getvalue().to_pybytes()] + [None] * len(blobs), pa.binary()),
            pa.array([None, *blobs], pa.binary()),
        ],
        ["shard", "packet", "directory", "elements"],
    )


def _packets(n: int, shards: int):
    """Batches of (key, text, hash) into packets; a row without a key has no elements there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        rows, taken, size = [], [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, 1_000):
                batch = whole.slice(at, 1_000)
                own = [s for chunk in chunks(batch.column(1), TEXT_BYTES) for s in sets(chunk, n)]
                rows.append(
                    pa.RecordBatch.from_arrays(
                        [
                            batch.column(0), pa.array([len(s) for s in own], pa.int64()),
                            pa.array([class_of(s) if len(s) else None for s in own], pa.int64()),
                            pa.array([bucket_counts(s) if len(s) else None for s in own], pa.binary()),
                            batch.column(2),
                        ],
                        ["key", "size", "class", "counts", "hash"],
                    )
                )
                keyed = batch.column(0).is_valid().to_pylist()
                taken += [s if there else s[:0] for s, there in zip(own, keyed)]
                size += sum(map(len, own))
                if size >= PACKET_ELEMENTS or len(taken) >= PACKET_ROWS:
                    yield _packet(number, rows, taken, shards)
                    number, rows, taken, size = number + 1, [], [], 0
        if rows:
            yield _packet(number, rows, taken, shards)

    return run


def _met(table: pa.Table) -> pa.Table:
    """The packets of one shard into the rows of each packet, once for every element that another row holds."""
    plain = table.column("elements").is_null()
    directories = table.filter(plain).select(["packet", "directory"])
    packets = table.filter(table.column("elements").is_valid())
    blobs = packets.column("elements").to_pylist()
    sizes = [len(b) // 6 for b in blobs]
    starts = np.cumsum([0, *sizes])
    place = np.arange(starts[-1], dtype=_U)
    for blob, low, high in zip(blobs, starts, starts[1:]):
        place[low:high] |= np.frombuffer(blob, "<u4", high - low).astype(_U) << _U(32)
    place.sort()
    same = place[1:] >> _U(32) == place[:-1] >> _U(32)
    edge = np.zeros(min(1, len(place)), bool)
    twice = np.concatenate([edge, same]) | np.concatenate([same, edge])
    at = np.sort((place[twice] & _U(0xFFFFFFFF)).astype(np.int64))
    hits = []
    for blob, size, low, high in zip(
        blobs, sizes, starts, np.split(at, np.searchsorted(at, starts[1:-1])) if blobs else ()
    ):
        row = np.frombuffer(blob, np.uint8, 2 * size, 4 * size).reshape(2, -1)
        hits.append(row[:, high - low].T.tobytes())
    nothing = pa.nulls(len(hits), pa.binary())
    return pa.table(
        {
            "packet": pa.chunked_array([*directories["packet"].chunks, *packets["packet"].chunks], pa.int64()),
            "directory": pa.chunked_array([*directories["directory"].chunks, nothing], pa.binary()),
            "hits": pa.chunked_array(
                [pa.nulls(len(directories), pa.binary()), pa.array(hits, pa.binary())], pa.binary()
            ),
        }
    )


def _settled(percent: int):
    """The directory and the hits of one packet into its rows."""

    def run(table: pa.Table) -> pa.Table:
        blobs = table.column("directory").drop_null().to_pylist()
        rows = pa.ipc.open_stream(blobs[0]).read_all()
        hits = np.frombuffer(b"".join(table.column("hits").drop_null().to_pylist()), "<u2")
        met = np.bincount(hits, minlength=len(rows))
        size = rows.column("size").to_numpy()
        held = (size > 0) & (100 * met >= percent * size)
        return rows.append_column("held", pa.array(held))

    return run


def described(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """``(key, size, class, counts, hash, held)`` of rows (key, text, hash).

    Class and counts are null for empty sets. ``held`` tells whether other rows with a key hold so many
    of the row's elements that it may have a link; elements are compared by some 40 bits of their hashes,
    which can make it true where it need not be. Texts do not move, only their elements' hashes.
    """
    kind = rows.schema["key"].dataType.simpleString()
    shards = 2 * shuffle_partitions(rows.sparkSession)
    met = (
        rows.mapInArrow(
            _packets(n, shards), "shard int, packet long, directory binary, elements binary"
        )
        .groupBy("shard")
        .applyInArrow(_met, "packet long, directory binary, hits binary")
    )
    return (
        stored(met, "elements-met")
        .groupBy("packet")
        .applyInArrow(
            _settled(percent),
            f"key {kind}, size long, class long, counts binary, hash long, held boolean",
        )
    )


def postings(rows: DataFrame, weight: np.ndarray, n: int, percent: int) -> DataFrame:
    """``(element, class)`` for the elements through which a class can find its links."""
    held = rows.sparkSession.sparkContext.broadcast(weight)  # of fixed size, see COUNTER_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0), TEXT_BYTES):
                own = {class_of(s): s for s in sets(chunk, n) if len(s)}
                parts = [prefix(s, held.value, percent) for s in own.values()]
                if parts:
                    names = np.repeat(np.array(list(own), np.int64), [len(p) for p in parts])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(parts).view(np.int64)), pa.array(names)],
                        ["element", "class"],
                    )

    return rows.select("text").mapInArrow(run, "element long, class long")


def regions(found: DataFrame) -> DataFrame:
    """``(pivot, member)``: each element's smallest class is the pivot of the others."""
    in_order = Window.partitionBy("element").orderBy("class")
    first = F.first("class").over(in_order)
    return (
        found.select(first.alias("pivot"), F.col("class").alias("member"))
        .where("pivot != member")
        .distinct()
    )


def _coarse(percent: int):
    """The regions of one shard into links (a, b) between classes that may be linked."""

    def run(table: pa.Table) -> pa.Table:
        pivot = table.column("pivot").to_numpy()
        member = table.column("member").to_numpy()
        counts = table.column("counts").to_pylist()
        order = np.argsort(pivot, kind="stable")
        cuts = np.flatnonzero(np.diff(pivot[order])) + 1
        a, b = [], []
        for own in np.split(order, cuts):
            forest = Forest(len(own))
            levels = np.array([counts[i][0] for i in own])
            unsure = np.flatnonzero(levels == 0)
            if len(unsure):
                forest.join(int(unsure[0]), np.arange(len(own)))
            for level in np.unique(levels[levels > 0]):
                # Linked sets differ by a third in size at most, so by one level.
                near = np.flatnonzero((levels == level) | (levels == level + 1))
                if len(near) < 2:
                    continue
                rows = np.empty((len(near), 1 << level), np.uint16)
                for k, i in enumerate(near):
                    raw = np.frombuffer(counts[own[i]], np.uint8)[1:]
                    rows[k] = raw if levels[i] == level else raw.reshape(-1, 2).sum(axis=1)
                local = Forest(len(near))
                link(Counts(rows, percent), np.arange(len(near)), local)
                heads = local.roots(np.arange(len(near)))
                for k in np.flatnonzero(heads != np.arange(len(near))):
                    forest.join(int(near[heads[k]]), near[k : k + 1])
            heads = forest.roots(np.arange(len(own)))
            linked = np.flatnonzero(heads != np.arange(len(own)))
            a.append(member[own[heads[linked]]])
            b.append(member[own[linked]])
        nothing = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate(a or [nothing]), "b": np.concatenate(b or [nothing])})

    return run


def coarse_links(pairs: DataFrame, counts: DataFrame, percent: int, most: int) -> DataFrame:
    """Links between classes that the bucket counts ``(class, counts)`` do not keep apart.

    A region with more than ``most`` members is not compared here: it counts as linked, and the exact
    join takes it apart.
    """
    sizes = pairs.groupBy("pivot").agg(F.count("*").alias("n"))
    sized = pairs.join(sizes, "pivot")
    large = sized.where(F.col("n") > most).select(
        F.col("pivot").alias("a"), F.col("member").alias("b")
    )
    small = sized.where(F.col("n") <= most)
    own = small.select("pivot", "member").union(small.select("pivot", "pivot").distinct())
    shards = shuffle_partitions(pairs.sparkSession)
    # Only counts of members of regions move, once for each class.
    named = likely(counts.withColumnRenamed("class", "member"), own, "member")
    counted = own.join(named.dropDuplicates(["member"]), "member").withColumn(
        "shard", F.pmod(F.xxhash64("pivot"), F.lit(shards))
    )
    links = counted.groupBy("shard").applyInArrow(_coarse(percent), "a long, b long")
    return links.union(large)


def _exact(n: int, percent: int):
    """The cells of one shard into links (a, b) of classes, each to the first of its component."""

    def run(table: pa.Table) -> pa.Table:
        cell = table.column("cell").to_numpy()
        member = table.column("member").to_numpy()
        texts = table.column("text").combine_chunks()
        own_sets = [s for chunk in chunks(texts, TEXT_BYTES) for s in sets(chunk, n)]
        order = np.lexsort((member, cell))
        a, b = [], []
        for own in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
            forest = Forest(len(own))
            link(Sets([own_sets[i] for i in own], percent), np.arange(len(own)), forest)
            heads = forest.roots(np.arange(len(own)))
            linked = np.flatnonzero(heads != np.arange(len(own)))
            a.append(member[own[heads[linked]]])
            b.append(member[own[linked]])
        nothing = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate(a or [nothing]), "b": np.concatenate(b or [nothing])})

    return run


def _to_pivots(n: int, percent: int):
    """A part of a large cell and the cell's pivots into the distances of each member to them."""

    def run(table: pa.Table) -> pa.Table:
        member = table.column("member").to_numpy()
        rank = table.column("rank").to_numpy()
        texts = table.column("text").combine_chunks()
        space = Sets([s for chunk in chunks(texts, TEXT_BYTES) for s in sets(chunk, n)], percent)
        pivots = np.flatnonzero(rank > 0)
        pivots = pivots[np.argsort(rank[pivots])]
        others = np.flatnonzero(rank == 0)
        distances = np.zeros((len(others), len(pivots)))
        linked = np.zeros((len(others), len(pivots)), bool)
        for k, p in enumerate(pivots if len(others) else ()):
            distances[:, k], linked[:, k] = space.compare(p, others)
        return pa.table(
            {
                "cell": table.column("cell").take(pa.array(others)),
                "member": pa.array(member[others]),
                "size": pa.array(space.sizes[others]),
                "distances": pa.array(list(distances), pa.list_(pa.float64())),
                "linked": pa.array(
                    [member[pivots[x]].tolist() for x in linked], pa.list_(pa.int64())
                ),
            }
        )

    return run


def _split(cells: DataFrame, large: DataFrame, texts: DataFrame, n: int, percent: int,
           elements: int, pivots: int, turn: int) -> tuple[DataFrame, DataFrame]:
    """One level of the recursion as Spark jobs: links to pivots, and the smaller cells that remain.

    ``cells (cell, member, size)``, ``large (cell, total)``, ``texts (member, text)``.
    """
    own = cells.join(large, "cell")
    spread = Window.partitionBy("cell").orderBy(F.xxhash64("member", F.lit(turn)), "member")
    chosen = stored(
        own.withColumn("rank", F.row_number().over(spread))
        .where(F.col("rank") <= pivots)
        .join(texts, "member"),
        "cell-pivots",
    )
    parts = F.ceil(F.col("total") / elements).cast("int")
    part = F.pmod(F.xxhash64("member"), parts).cast("int")
    dealt = own.join(texts, "member").select(
        "cell", part.alias("part"), "member", F.lit(0).alias("rank"), "text"
    )
    copies = chosen.select(
        "cell", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "member", "rank", "text"
    )
    kind = cells.schema["cell"].dataType.simpleString()
    measured = stored(
        dealt.union(copies)
        .groupBy("cell", "part")
        .applyInArrow(
            _to_pivots(n, percent),
            f"cell {kind}, member long, size long, distances array<double>, linked array<long>",
        ),
        "cell-distances",
    )
    links = measured.select(F.explode("linked").alias("a"), F.col("member").alias("b"))
    radius = 1 - percent / 100
    rest = measured.join(chosen.select("cell", "member"), ["cell", "member"], "left_anti")
    rest = rest.withColumn("own", F.array_min("distances")).withColumn(
        "home", F.array_position("distances", F.col("own")).cast("int")
    )
    reach = rest.groupBy("cell", "home").agg(F.max("own").alias("reach"))
    placed = rest.select(
        "cell", "member", "size", "own", F.posexplode("distances").alias("at", "d")
    ).withColumn("home", F.col("at") + 1)
    inside = (F.col("d") <= F.col("own") + 2 * radius + 1e-9) & (
        F.col("d") <= F.col("reach") + radius + 1e-9
    )
    smaller = (
        placed.join(reach, ["cell", "home"])
        .where(inside)
        .select(F.xxhash64("cell", "home", F.lit(turn)).alias("cell"), "member", "size")
    )
    return links, smaller


def exact_links(
    cells: DataFrame, texts: DataFrame, n: int, percent: int, elements: int, pivots: int
) -> DataFrame:
    """All links that matter for the components, within cells ``(cell, member, size)``."""
    found: list[DataFrame] = []
    turn = 0
    shards = shuffle_partitions(cells.sparkSession)
    while True:
        totals = cells.groupBy("cell").agg(F.sum("size").alias("total"))
        large = stored(totals.where(F.col("total") > elements), "large-cells")
        small = cells.join(large, "cell", "left_anti")
        shard = F.pmod(F.xxhash64("cell"), F.lit(shards)).alias("shard")
        found.append(
            small.join(texts, "member")
            .select(shard, "cell", "member", "text")
            .groupBy("shard")
            .applyInArrow(_exact(n, percent), "a long, b long")
        )
        if large.isEmpty():
            break
        links, smaller = _split(cells, large, texts, n, percent, elements, pivots, turn)
        found.append(links)
        # A cell whose members all hang together already is finished.
        known = stored(links, "cell-links")
        for_members = components(known).select(F.col("node").alias("member"), "component")
        named = smaller.join(for_members, "member", "left").withColumn(
            "component", F.coalesce("component", "member")
        )
        ends = named.groupBy("cell").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        )
        open_ = ends.where("low != high").select("cell")
        cells = stored(smaller.join(open_, "cell", "left_semi"), "cells")
        turn += 1
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def similar_groups(
    df: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT,
    region_members: int = REGION_MEMBERS, cell_elements: int = CELL_ELEMENTS, pivots: int = 8,
) -> DataFrame:
    """Every row's key, ``n_shingles``, ``class_id``, ``component_id``, ``group_id`` and ``text_hash``.

    ``component_id`` is the smallest key that links lead to, its own included. ``class_id`` is equal for
    rows with equal sets, null for empty ones. ``group_id`` is equal for rows that links connect; unlike
    ``component_id`` it tells texts apart that share a key. The key has to be an integer.
    """
    rows = _rows(df, key, text)
    every = stored(described(rows.withColumn("hash", F.xxhash64("text")), n, percent), "sets")
    whole = every.where("class IS NOT NULL AND key IS NOT NULL")
    classes = whole.groupBy("class").agg(
        F.min("key").alias("first"), F.first("size").alias("size"), F.max("held").alias("held")
    )
    # One text stands for a class; rows with its key but another set are told apart by the class.
    firsts = classes.where("held").select(F.col("first").alias("key"), F.col("class").alias("member"))
    taking_part = rows.where("key IS NOT NULL AND text IS NOT NULL")
    candidates = stored(_texts_of(taking_part, firsts, n), "class-texts")
    among = candidates.select(F.col("member").alias("key"), "text", F.lit(0).cast("long").alias("hash"))
    again = stored(described(among, n, percent).where("held").select("class", "counts"), "class-sets")
    held = again.select(F.col("class").alias("member"))
    texts = stored(candidates.join(held, "member", "left_semi"), "cell-texts")
    weight = element_weights(texts.select("text"))
    pairs = stored(regions(postings(texts, weight, n, percent)), "regions")
    apart = components(coarse_links(pairs, again, percent, region_members))
    members = stored(
        apart.join(classes.select(F.col("class").alias("node"), "size"), "node").select(
            F.col("component").alias("cell"), F.col("node").alias("member"), "size"
        ),
        "cells",
    )
    links = exact_links(members, texts, n, percent, cell_elements, pivots)
    found = components(links).select(F.col("node").alias("class"), "component")
    named = classes.select("class", "first").join(found, "class", "left")
    named = named.withColumn("component", F.coalesce("component", "class"))
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    by_class = named.join(lowest, "component").select("class", "component", "component_id")
    own = F.when(F.col("class").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return every.join(by_class, "class", "left").select(
        F.col("key").alias(key), F.col("size").alias("n_shingles"), F.col("class").alias("class_id"),
        F.when(F.col("key").isNotNull(), own).alias("component_id"),
        F.when(F.col("key").isNotNull(), F.col("component")).alias("group_id"),
        F.col("hash").alias("text_hash"),
    )


def _texts_of(rows: DataFrame, firsts: DataFrame, n: int) -> DataFrame:
    """``(member, text)`` for each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [class_of(s) for chunk in chunks(batch.column(1), TEXT_BYTES) for s in sets(chunk, n)]
            same = pa.array([a == b for a, b in zip(names, batch.column(0).to_pylist())])
            yield batch.filter(same)

    picked = likely(rows, firsts, "key").join(firsts, "key").select("member", "text")
    return picked.mapInArrow(run, "member long, text string").dropDuplicates(["member"])
