"""Passages that repeat across documents: candidates, and what is left without them.

A sequence (the words or the bytes of a text) has a window at every place from which ``window`` symbols
follow. A window counts as repeated when an equal one starts in a document with a smaller key. Windows
are compared in four steps, none of which needs all of the corpus in one place:

1. Each window chooses its anchor, the slice of ``anchor`` symbols in it with the smallest hash (the
   leftmost of equal ones). Equal windows choose equal anchors, so they meet at the anchor's hash.
   Neighbouring windows mostly share an anchor; such a run of windows is one *occurrence*.
   Slices that are frequent in the table are passed over, so that no anchor gathers very many
   occurrences; a window of frequent slices only is an occurrence by itself, with its own hash for an
   anchor. Any set of frequent slices gives the same result, so they are counted on a sample.
2. Occurrences meet in shards by anchor hash. Where the contents of two are equal as a whole, the one
   in the later document is repeated. An anchor with different contents leaves a *contest*: the first
   document of each content is still to be searched for windows that other contents hold. Equal windows
   have half of what a window holds besides the anchor in common on its left or on its right, so contents
   meet in a contest only if a hash of either side is equal; chance makes many equal anchors in a large
   corpus, but hardly any equal sides.
   Equal contents within some megabytes are settled before the shuffle, so that a passage which very
   many documents share crosses it once for each such stretch.
3. Contested occurrences fetch their symbols. Those that hold a window of another document, by the
   windows' hashes, are searched, shard by shard, by an index over them (``search``, which an operator
   supplies).
4. Repeated places go back to their documents.

Hashes of contents have 104 bits together with the anchor's, 64 of them within one anchor; the search in
step 3 compares symbols.

Rows are told apart by key and text. Rows with the same key never make each other's windows repeated.
A null key takes no part: its text is kept whole. A null text is empty. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.arrays import BYTE_CODES, Chunk, chunks, expand, mix, rolling, word_codes, words
from feedloom.llm.tables import FILTER_PLACES, shuffle_partitions, stored

_U = np.uint64
_PLACE_BITS = 24
# Bytes of texts taken apart at once; arrays of that many numbers stay in a core's cache.
TEXT_BYTES = 1 << 18
# Text whose occurrences are settled and packed together.
PACKED_BYTES = 8 << 20
# Symbols that one in-memory index holds at most, and the segments of one anchor besides.
INDEX_SYMBOLS = 400_000
# A slice that stands in so many places is no anchor; about half as many may do.
FREQUENT = 8_000
# So many of a frequent slice's places are sampled.
_SAMPLED = 128


class Kind(NamedTuple):
    """What the sequences are made of."""

    name: str
    window: int
    anchor: int
    symbols: Callable[[Chunk], tuple[np.ndarray, np.ndarray]]  # codes, bounds of rows
    dtype: str  # of a symbol in a contested segment


def _byte_symbols(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_CODES[chunk.data], chunk.bounds


def _word_symbols(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    found = words(chunk)
    return word_codes(chunk, found), found.bounds


def of_bytes(window: int = 50, anchor: int = 20) -> Kind:
    return Kind("bytes", window, anchor, _byte_symbols, "u1")


def of_words(window: int = 50, anchor: int = 10) -> Kind:
    return Kind("words", window, anchor, _word_symbols, "u8")


class Occurrences(NamedTuple):
    """Runs of windows that share an anchor; places are relative to their rows."""

    row: np.ndarray
    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    content: np.ndarray
    # 16 bits of a hash of the symbols left and right of the anchor; 0 where no window holds them.
    left: np.ndarray | None = None
    right: np.ndarray | None = None

    def pick(self, which: np.ndarray) -> Occurrences:
        return Occurrences(*(column if column is None else column[which] for column in self))


def _joined_occurrences(parts: list[Occurrences]) -> Occurrences:
    return Occurrences(*(np.concatenate(column) for column in zip(*parts)))


def _sides(place: np.ndarray, start: np.ndarray, count: np.ndarray, kind: Kind, roll) -> list[np.ndarray]:
    """The hashes of the symbols left and right of the anchors."""
    rest = kind.window - kind.anchor
    half = rest // 2
    out = []
    for held, at in (
        (place - start >= half, place - half),
        (place - (start + count - 1) <= rest - half, place + kind.anchor),
    ):
        side = np.zeros(len(place), np.uint16)
        own = np.flatnonzero(held)
        side[own] = (roll.hashes(at[own], at[own] + half) % _U(0xFFFF)).astype(np.uint16) + np.uint16(1)
        out.append(side)
    return out


def occurrences(
    codes: np.ndarray, bounds: np.ndarray, kind: Kind, frequent: np.ndarray | None = None
) -> Occurrences:
    """``frequent`` tells for the low bits of a slice's hash whether it is passed over."""
    counts = np.maximum(0, np.diff(bounds) - kind.window + 1)
    if not counts.any():
        kinds = (np.int64, np.int64, np.int64, _U, _U, np.uint16, np.uint16)
        return Occurrences(*(np.zeros(0, t) for t in kinds))
    roll = rolling(codes)
    grams = roll.every(kind.anchor)
    bits = _U(max(_PLACE_BITS, len(grams).bit_length()))
    low = (grams >> bits << bits) | np.arange(len(grams), dtype=_U)
    last = ~_U(0) >> bits << bits
    if frequent is not None:
        passed = frequent[(grams & _U(FILTER_PLACES - 1)).astype(np.int64)]
        low[passed] |= last
    reach, width = kind.window - kind.anchor + 1, 1
    while 2 * width <= reach:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < reach:
        low = np.minimum(low[: len(low) - (reach - width)], low[reach - width :])
    starts = expand(bounds[:-1], counts)
    place = (low[starts] & _U((1 << int(bits)) - 1)).astype(np.int64)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    count = np.diff(np.append(first, len(place)))
    start = starts[first]
    row = np.searchsorted(bounds, start, "right") - 1
    anchor = grams[place[first]]
    left, right = _sides(place[first], start, count, kind, roll)
    # Windows without another slice: places differ from window to window, so each is a run of its own.
    bare = np.flatnonzero((low[start] & last) == last)
    if frequent is not None and len(bare):
        at, half = start[bare], kind.window // 2
        left[bare] = right[bare] = 0
        anchor[bare] = mix(
            roll.hashes(at, at + half) * _U(0xC2B2AE3D27D4EB4F)
            + roll.hashes(at + half, at + kind.window)
        )
    return Occurrences(
        row, start - bounds[row], count, anchor,
        roll.hashes(start, start + count - 1 + kind.window), left, right,
    )


def _ranked(
    anchor: np.ndarray, content: np.ndarray, doc: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by the anchor (of 40 bits) and content, where each content begins, its smallest document."""
    both = anchor << _U(24) | content >> _U(40)
    order = np.argsort(both)
    b, c = both[order], content[order]
    same, equal = b[1:] == b[:-1], c[1:] == c[:-1]
    if (same & ~equal).any():  # the low bits of contents decide
        order = np.lexsort((content, both))
        b, c = both[order], content[order]
        same, equal = b[1:] == b[:-1], c[1:] == c[:-1]
    new = np.append(True, ~(same & equal)) if len(b) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return order, new, np.minimum.reduceat(doc[order], first) if len(first) else doc[:0]


# A packet holds occurrences for one shard: documents, then one array after another.


def _pack(doc: np.ndarray, row_key: np.ndarray, occ: Occurrences, settled: bool) -> bytes:
    """Occurrences sorted by row and start; settled ones carry no hashes."""
    new = np.append(True, occ.row[1:] != occ.row[:-1])
    first = np.flatnonzero(new)
    step = np.diff(occ.start, prepend=0)
    step[first] = occ.start[first]
    parts = [
        np.array([len(first), len(occ.row)], "<i4"),
        doc[first].astype("<i8"), row_key[first].astype("<i8"),
        np.diff(np.append(first, len(occ.row))).astype("<i4"),
        step.astype("<u4").view(np.uint8).reshape(-1, 4).T.copy(),
        occ.count.astype("<u4" if settled else "<u2").view(np.uint8),
    ]
    if not settled:
        anyhow = np.ones(len(occ.row), "<u2")
        parts += [
            (occ.anchor >> _U(24)).view(np.uint8).reshape(-1, 8)[:, :5].copy(),
            occ.content.astype("<u8"),
            *(anyhow if side is None else side.astype("<u2") for side in (occ.left, occ.right)),
        ]
    return b"".join(p.tobytes() for p in parts)


def _unpack(packet: bytes, settled: bool):
    data = np.frombuffer(packet, np.uint8)
    n_docs, n = (int(x) for x in data[:8].view("<i4"))
    at = 8

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return data[at - size : at]

    doc, row_key = take(8 * n_docs).view("<i8"), take(8 * n_docs).view("<i8")
    sizes = take(4 * n_docs).copy().view("<i4")
    step = take(4 * n).reshape(4, -1).T.copy().view("<u4")[:, 0].astype(np.int64)
    wide = 4 if settled else 2
    count = take(wide * n).copy().view(f"<u{wide}").astype(np.int64)
    total = np.cumsum(step)
    first = np.cumsum(sizes) - sizes
    before = np.concatenate([[0], total])[first]
    start = total - np.repeat(before, sizes)
    hashes = []
    if not settled:
        anchor = np.zeros((n, 8), np.uint8)
        anchor[:, :5] = take(5 * n).reshape(-1, 5)
        hashes = [anchor.view("<u8")[:, 0], take(8 * n).copy().view("<u8")]
        hashes += [take(2 * n).copy().view("<u2") for _ in range(2)]
    return np.repeat(doc, sizes), np.repeat(row_key, sizes), start, count, hashes


def _joined(occ: Occurrences) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of windows begin that follow each other in a row, and how many windows each has."""
    if not len(occ.row):
        return occ.row, occ.count
    follows = (occ.row[1:] == occ.row[:-1]) & (occ.start[1:] == occ.start[:-1] + occ.count[:-1])
    first = np.flatnonzero(np.append(True, ~follows))
    return first, np.add.reduceat(occ.count, first)


def _packed(
    doc: np.ndarray, row_key: np.ndarray, occ: Occurrences, shards: int
) -> pa.RecordBatch:
    """The packets of some rows' occurrences, equal contents settled among them."""
    order, new, least = _ranked(occ.anchor >> _U(24), occ.content, doc)
    settled = np.zeros(len(doc), bool)
    settled[order] = doc[order] > least[np.cumsum(new) - 1]
    shard = (occ.anchor & _U(0xFFFFFF)).astype(np.int64) % shards
    out: list[list] = [[], [], []]
    for done in (False, True):
        which = np.flatnonzero(settled == done)
        own = row_key[which] % shards if done else shard[which]
        in_order = np.argsort(own.astype(np.uint16 if shards < 1 << 16 else _U), kind="stable")
        which, own = which[in_order], own[in_order]
        for group in np.split(np.arange(len(own)), np.flatnonzero(np.diff(own)) + 1):
            if len(group):
                pick = which[group]
                part = occ.pick(pick)
                if done:
                    first, count = _joined(part)
                    pick, part = pick[first], part.pick(first)._replace(count=count)
                out[0].append(int(own[group[0]]))
                out[1].append(done)
                out[2].append(_pack(doc[pick], row_key[pick], part, done))
    return pa.RecordBatch.from_arrays(
        [pa.array(out[0], pa.int32()), pa.array(out[1], pa.bool_()), pa.array(out[2], pa.binary())],
        ["shard", "settled", "packet"],
    )


def _sampled(kind: Kind, share: float) -> Callable:
    """Batches of texts into the hashes of a share of their slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(5)
        for batch in batches:
            for chunk in chunks(batch.column(0), TEXT_BYTES):
                codes = kind.symbols(chunk)[0]
                n = max(0, len(codes) - kind.anchor + 1)
                at = rng.integers(0, n, rng.binomial(n, share)) if share < 1 else np.arange(n)
                taken = rolling(codes).hashes(at, at + kind.anchor)
                yield pa.RecordBatch.from_arrays([pa.array(taken.view(np.int64))], ["slice"])

    return run


def frequent_slices(texts: DataFrame, kind: Kind, frequent: int) -> bytes:
    """A bit for every value of the low bits of a slice's hash: whether such a slice is frequent.

    The set has FILTER_PLACES places, whatever the table; a rare slice that shares one is passed over too.
    """
    share = min(1.0, _SAMPLED / frequent)
    found = (
        texts.mapInArrow(_sampled(kind, share), "slice long")
        .groupBy("slice")
        .count()
        .where(F.col("count") >= share * frequent / 2)
        .select(F.col("slice").bitwiseAND(FILTER_PLACES - 1).alias("place"))
        .distinct()
        .toArrow()
    )
    held = np.zeros(FILTER_PLACES, bool)
    held[found.column("place").to_numpy()] = True
    return np.packbits(held).tobytes()


def _packets(kind: Kind, shards: int, frequent: bytes) -> Callable:
    """Batches of (doc, row key, text) into (shard, settled, packet), some megabytes at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = np.unpackbits(np.frombuffer(frequent, np.uint8)).astype(bool)
        parts, size, base = [], 0, 0

        def packed() -> pa.RecordBatch:
            doc, row_key = (np.concatenate([p[i] for p in parts]) for i in range(2))
            return _packed(doc, row_key, _joined_occurrences([p[2] for p in parts]), shards)

        for batch in batches:
            docs, row_keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for chunk in chunks(batch.column(2), TEXT_BYTES):
                codes, bounds = kind.symbols(chunk)
                occ = occurrences(codes, bounds, kind, passed)
                if len(occ.row):
                    row = occ.row + chunk.first
                    parts.append((docs[row], row_keys[row], occ._replace(row=row + base)))
                    size += len(chunk.data)
                if size >= PACKED_BYTES:
                    yield packed()
                    parts, size = [], 0
            base += batch.num_rows
        if parts:
            yield packed()

    return run


def _blobs(sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    """Binary values of so many bytes each, one after another in ``data``."""
    offsets = np.append(0, np.cumsum(sizes)).astype("<i4")
    return pa.Array.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())]
    )


def spans_by_row(
    row_key: np.ndarray, start: np.ndarray, stop: np.ndarray
) -> tuple[np.ndarray, pa.Array]:
    """The keys, and each key's spans as ``spans_to_bytes`` of ``merge_spans`` gives them."""
    if not len(row_key):
        return row_key, pa.array([], pa.binary())
    order = np.lexsort((start, row_key))
    row_key = row_key[order]
    new = np.append(True, row_key[1:] != row_key[:-1])
    row = np.cumsum(new) - 1
    # Far enough apart that spans of different rows never touch.
    start, stop = start[order] + (row << 33), stop[order] + (row << 33)
    reach = np.maximum.accumulate(stop)
    first = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
    last = np.append(first[1:] - 1, len(start) - 1)
    own = row[first]
    spans = np.stack([start[first], reach[last]], axis=1) - (own << 33)[:, None]
    return row_key[new], _blobs(8 * np.bincount(own), spans.astype("<i4"))


_RESOLVED = "row_key long, repeated binary, contested binary"
_CONTEST = np.dtype([("anchor", "<u8"), ("start", "<i4"), ("count", "<i4")])


def _open(group: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether a group (its members stand together) has a member whose first document is not the group's."""
    if not len(group):
        return np.zeros(0, bool)
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(first, len(group)))
    # The first document of all has nothing before it.
    later = least > np.repeat(np.minimum.reduceat(least, first), sizes)
    return np.repeat(np.maximum.reduceat(later, first), sizes)


def _resolve(kind: Kind) -> Callable:
    """The packets of one shard into repeated spans and contests of each row."""

    def run(packets: pa.Table) -> pa.Table:
        settled = packets.column("settled").to_pylist()
        blobs = packets.column("packet").to_pylist()
        done = [_unpack(b, True) for b, s in zip(blobs, settled) if s]
        open_ = [_unpack(b, False) for b, s in zip(blobs, settled) if not s]
        nothing = np.zeros(0, np.int64)
        join = lambda parts, i: np.concatenate([p[i] for p in parts]) if parts else nothing
        doc, row_key, start, count = (join(open_, i) for i in range(4))
        anchor, content, left, right = (
            np.concatenate([p[4][i] for p in open_]) if open_ else nothing.astype(_U)
            for i in range(4)
        )
        order, new, least = _ranked(anchor, content, doc)
        content_at = np.cumsum(new) - 1
        later = np.zeros(len(doc), bool)
        later[order] = doc[order] > least[content_at]
        # Anchors with several contents, of which the first documents differ; then sides of them.
        head = order[new]
        several = np.flatnonzero(_open(anchor[head], least))
        contest = np.zeros(len(head), bool)
        for side in (left, right):
            own = several[side[head[several]] > 0]
            both = anchor[head[own]] << _U(16) | side[head[own]].astype(_U)
            by_side = np.argsort(both)
            own = own[by_side]
            contest[own[_open(both[by_side], least[own])]] = True
        contested = np.zeros(len(doc), bool)
        contested[order] = contest[content_at]
        contested &= ~later
        starts = np.concatenate([start[later], join(done, 2)])
        stops = starts + np.concatenate([count[later], join(done, 3)]) - 1 + kind.window
        repeated, spans = spans_by_row(np.concatenate([row_key[later], join(done, 1)]), starts, stops)
        at = np.flatnonzero(contested)
        at = at[np.argsort(row_key[at], kind="stable")]
        wanted = np.zeros(len(at), _CONTEST)
        wanted["anchor"], wanted["start"], wanted["count"] = anchor[at], start[at], count[at]
        keys, n = np.unique(row_key[at], return_counts=True)
        none = np.zeros(0, np.uint8)
        return pa.table(
            {
                "row_key": pa.array(np.concatenate([repeated, keys]), pa.int64()),
                "repeated": pa.chunked_array([spans, _blobs(0 * n, none)], pa.binary()),
                "contested": pa.chunked_array(
                    [_blobs(np.zeros(len(repeated), np.int64), none),
                     _blobs(_CONTEST.itemsize * n, wanted)], pa.binary(),
                ),
            }
        )

    return run


def merge_spans(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans joined where they overlap or touch, in order."""
    if not len(start):
        return start, stop
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    new = np.append(True, start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return start[first], reach[np.append(first[1:] - 1, len(start) - 1)]


def spans_to_bytes(start: np.ndarray, stop: np.ndarray) -> bytes:
    return np.stack([start, stop], axis=1).astype("<i4").tobytes()


def spans_from_bytes(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(blobs), "<i4").reshape(-1, 2).astype(np.int64)
    return merge_spans(both[:, 0], both[:, 1])


def _segments(kind: Kind) -> Callable:
    """Rows with their contests into the contested symbols: (anchor, doc, row key, start, symbols)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            docs = batch.column(1).to_numpy()
            blobs = batch.column(3).to_pylist()
            for chunk in chunks(batch.column(2), TEXT_BYTES):
                codes, bounds = kind.symbols(chunk)
                data = chunk.data if kind.dtype == "u1" else codes
                out: list[list] = [[], [], [], [], []]
                for row in range(chunk.last - chunk.first):
                    own = np.frombuffer(b"".join(blobs[chunk.first + row]), _CONTEST)
                    base = bounds[row]
                    for anchor, start, count in own.tolist():
                        at = base + start
                        out[0].append(anchor)
                        out[1].append(docs[chunk.first + row])
                        out[2].append(keys[chunk.first + row])
                        out[3].append(start)
                        out[4].append(data[at : at + count - 1 + kind.window].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                     pa.array(out[2], pa.int64()), pa.array(out[3], pa.int32()),
                     pa.array(out[4], pa.binary())],
                    ["anchor", "doc", "row_key", "start", "symbols"],
                )

    return run


def _symbols_of(column: pa.ChunkedArray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all segments one after another, and the segments' bounds."""
    blobs = [c for c in column.chunks if len(c)]
    sizes = [np.diff(np.frombuffer(c.buffers()[1], "<i4")[c.offset : c.offset + len(c) + 1]) for c in blobs]
    parts = [
        np.frombuffer(c.buffers()[2], np.uint8, int(n.sum()), int(np.frombuffer(c.buffers()[1], "<i4")[c.offset]))
        for c, n in zip(blobs, sizes)
    ]
    bounds = np.append(0, np.cumsum(np.concatenate([*sizes, np.zeros(0, np.int64)]), dtype=np.int64))
    data = np.concatenate([*parts, np.zeros(0, np.uint8)]).view(dtype)
    return data, bounds // np.dtype(dtype).itemsize


def _with_shared_windows(kind: Kind, column: pa.ChunkedArray, doc: np.ndarray) -> np.ndarray:
    """The segments with a window whose hash a segment of another document has as well."""
    data, bounds = _symbols_of(column, kind.dtype)
    hashes, owner = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
    low = 0
    while low < len(doc):
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + TEXT_BYTES, "right")) - 1)
        own = data[bounds[low] : bounds[high]]
        counts = np.diff(bounds[low : high + 1]) - kind.window + 1
        every = rolling(BYTE_CODES[own] if kind.dtype == "u1" else own).every(kind.window)
        hashes.append(every[expand(bounds[low:high] - bounds[low], counts)])
        owner.append(np.repeat(np.arange(low, high), counts))
        low = high
    found, segment = np.concatenate(hashes), np.concatenate(owner)
    shared = np.zeros(len(doc), bool)
    if len(found):
        order = np.argsort(found)
        found, segment = found[order], segment[order]
        first = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
        docs = doc[segment]
        several = np.minimum.reduceat(docs, first) < np.maximum.reduceat(docs, first)
        shared[segment[np.repeat(several, np.diff(np.append(first, len(found))))]] = True
    return np.flatnonzero(shared)


# search(symbols, bounds, doc) -> for every symbol whether a repeated window starts there
Search = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _searched(kind: Kind, search: Search) -> Callable:
    """The segments of one shard, in indexes of bounded size, into repeated spans of each row."""

    def run(table: pa.Table) -> pa.Table:
        doc = table.column("doc").to_numpy()
        table = table.take(pa.array(_with_shared_windows(kind, table.column("symbols"), doc)))
        doc = table.column("doc").to_numpy()
        anchor = table.column("anchor").to_numpy()
        row_key = table.column("row_key").to_numpy()
        start = table.column("start").to_numpy().astype(np.int64)
        texts = table.column("symbols").to_pylist()
        order = np.lexsort((doc, anchor))
        sizes = np.array([len(texts[i]) for i in order], np.int64) // np.dtype(kind.dtype).itemsize
        a = anchor[order]
        first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
        weight = np.add.reduceat(sizes, first) if len(first) else sizes
        bin_ = (np.cumsum(weight) - weight) // INDEX_SYMBOLS
        cuts = np.append(first[np.flatnonzero(np.diff(bin_, prepend=-1))], len(order))
        out: dict[int, list[bytes]] = {}
        for low, high in zip(cuts, cuts[1:]):
            # Equal segments are indexed once, for their first document.
            place: dict[tuple[int, bytes], int] = {}
            kept: list[int] = []
            which = np.empty(high - low, np.int64)
            for j, i in enumerate(order[low:high]):
                name = anchor[i], texts[i]
                if name not in place:
                    place[name] = len(kept)
                    kept.append(i)
                which[j] = place[name]
            symbols = np.frombuffer(b"".join(texts[i] for i in kept), kind.dtype)
            bounds = np.concatenate(
                [[0], np.cumsum([len(texts[i]) for i in kept])]
            ) // np.dtype(kind.dtype).itemsize
            hit = search(symbols, bounds, doc[kept])
            for j, i in enumerate(order[low:high]):
                own = np.flatnonzero(hit[bounds[which[j]] : bounds[which[j] + 1]])
                if len(own):
                    spans = merge_spans(start[i] + own, start[i] + own + kind.window)
                    out.setdefault(int(row_key[i]), []).append(spans_to_bytes(*spans))
        return pa.table(
            {
                "row_key": pa.array(list(out), pa.int64()),
                "repeated": pa.array([b"".join(v) for v in out.values()], pa.binary()),
            }
        )

    return run


def with_repeats(
    df: DataFrame, kind: Kind, search: Search, key: str, text: str, keep: list[str],
    frequent: int = FREQUENT,
) -> DataFrame:
    """Every row's ``text``, ``repeated`` (its spans as packed places, or null) and kept columns.

    The columns of ``keep`` come under the names ``_0``, ``_1`` and so on. Slices in ``frequent`` places
    and more are no anchors.
    """
    partitions = shuffle_partitions(df.sparkSession)
    # A shard is held in memory as a whole; two of them make up an ordinary partition.
    shards = 2 * partitions
    rows = df.select(
        F.col(key).cast("bigint").alias("doc"), F.xxhash64(key, text).alias("row_key"),
        F.col(text).alias("text"),
        *[F.col(c).alias(f"_{i}") for i, c in enumerate(keep) if c != text],  # the text moves once
    )
    compared = rows.where(F.col("doc").isNotNull() & F.col("text").isNotNull())
    passed = frequent_slices(compared.select("text"), kind, frequent)
    packets = compared.select("doc", "row_key", "text").mapInArrow(
        _packets(kind, shards, passed), "shard int, settled boolean, packet binary"
    )
    resolved = stored(
        packets.groupBy("shard").applyInArrow(_resolve(kind), _RESOLVED), f"repeats-{kind.name}"
    )
    texts = rows.repartition(partitions, "row_key")
    contests = (
        resolved.where(F.length("contested") > 0)
        .groupBy("row_key")
        .agg(F.collect_list("contested").alias("contested"))
    )
    segments = (
        texts.join(contests.hint("shuffle_hash"), "row_key")
        .select("row_key", "doc", "text", "contested")
        .mapInArrow(
            _segments(kind), "anchor long, doc long, row_key long, start int, symbols binary"
        )
    )
    searched = (
        segments.withColumn("shard", F.pmod("anchor", F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(_searched(kind, search), "row_key long, repeated binary")
    )
    found = (
        resolved.where(F.length("repeated") > 0)
        .select("row_key", "repeated")
        .union(searched)
        .groupBy("row_key")
        .agg(F.collect_list("repeated").alias("repeated"))
    )
    kept = [F.col("text" if c == text else f"_{i}").alias(f"_{i}") for i, c in enumerate(keep)]
    return texts.join(found.hint("shuffle_hash"), "row_key", "left").select("text", "repeated", *kept)


def suffix_order(ranks: np.ndarray) -> np.ndarray:
    """The suffix array of a sequence whose suffixes all differ, by doubling the sorted prefix."""
    n, width = len(ranks), 1
    while True:
        order = np.argsort(ranks)
        in_order = ranks[order]
        dense = np.cumsum(np.append(0, in_order[1:] != in_order[:-1]))
        if dense[-1] == n - 1:
            return order
        settled = np.empty(n, np.int64)
        settled[order] = dense
        ranks = settled * (n + 1)
        ranks[: n - width] += settled[width:] + 1
        width *= 2
