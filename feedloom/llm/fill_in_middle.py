"""Fill-in-the-middle texts, put together by a secondary sort, and taken apart again.

A text is cut into units, its lines with their ends. Two of the unit bounds, drawn by a hash of the key,
divide it into prefix, middle and suffix. The output holds the middle last, every segment behind its mark:
``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` is ``<S>`` suffix ``<P>`` prefix ``<M>``
middle. A text that is empty, that holds a mark or that the rate passes over stays ``plain``.

1. ``pieces`` emits runs of units of at most ``PIECE_BYTES`` bytes (a longer unit in several pieces), keyed
   by document and place in the output, shuffles them by document and sorts every partition. A partition
   then holds whole outputs, piece after piece.
2. ``digests`` streams them into one incremental digest per document. The marks at the heads of pieces
   tell the segments, and from those follows the place in the text. The pieces are sorted again by that
   place inside their partition, without a shuffle, and streamed into the digest of the restored text.
   ``texts`` joins the pieces to the outputs themselves, one document at a time.

A step holds one batch of pieces, whatever the length of the texts; sorting spills. Every draw depends on
the key and the seed alone, so a repeated task repeats its pieces.

- Null and empty texts have no unit: ``plain``, an empty output.
- A null key draws by the seed alone.
- Rows of one task with equal key and text are worked on once and told as often as they came. Other rows
  with equal keys have their pieces apart, by a hash of the text and the number of the task, so that no
  number of copies meets in one task.
- Very long texts are many pieces. Further columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from feedloom.llm.arrays import chunks

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
MARKS = {PREFIX.encode(): 0, MIDDLE.encode(): 1, SUFFIX.encode(): 2}  # by their place in the text
MARK_BYTES = 3

SEED = 7
RATE = 100  # of 100 texts so many are rearranged
SPM_RATE = 50  # and of 100 of these so many begin with the suffix
PIECE_BYTES = 1 << 16
ROWS = 1_000  # of a batch of pieces

# What a document's pieces have in common; a task's rows with equal key and text are one document.
_DOCUMENT = ["doc", "fingerprint", "task"]
_END = (1 << 62) - 1


def draws(key: str, seed: int) -> list[Column]:
    """Four whole numbers from the hash of seed and key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def _runs(low: int, high: int, ends: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Cut bytes low..high into runs of whole units, or parts of a unit that is longer than ``limit``."""
    out = []
    while high - low > limit:
        at = int(np.searchsorted(ends, low + limit, "right")) - 1
        cut = int(ends[at]) if at >= 0 and ends[at] > low else low + limit
        out.append((low, cut))
        low = cut
    return [*out, (low, high)]


class _Rows:
    """Rows gathered into batches of a schema; yields a batch when it is full."""

    def __init__(self, schema: StructType, kinds: list[pa.DataType]):
        self.names, self.kinds = schema.names, kinds
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, *row, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += size
        if len(self.rows) >= ROWS or self.bytes >= ROWS * 4096:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, k) for c, k in zip(zip(*self.rows), self.kinds)]
            self.rows, self.bytes = [], 0
            yield pa.RecordBatch.from_arrays(columns, self.names)


def _cut(chunk, row: int, ends: np.ndarray, h: list[int], limit: int, plain: bool):
    """A text's number of units, segments ``(mark, runs)`` in the text's order, and their bounds."""
    low, high = int(chunk.bounds[row]), int(chunk.bounds[row + 1])
    first, last = np.searchsorted(ends, (low, high), "right")  # ends of units lie behind their line feed
    own = ends[first:last]
    n = len(own) + (high > low and (not len(own) or own[-1] != high))
    if plain:
        return n, [(b"", _runs(low, high, own, limit))], None
    edge = lambda k: low if k == 0 else high if k == n else int(own[k - 1])
    a, b = sorted((edge(h[0] % (n + 1)), edge(h[1] % (n + 1))))
    parts = ((PREFIX, low, a), (MIDDLE, a, b), (SUFFIX, b, high))
    return n, [(mark.encode(), _runs(x, y, own, limit)) for mark, x, y in parts], (low, a, b)


def _emit(kinds: list[pa.DataType], schema: StructType, limit: int, rate: int, spm_rate: int):
    """Rows of documents into heads (position 0) and pieces (from 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, task = _Rows(schema, kinds), TaskContext.get().partitionId()
        for batch in batches:
            keys, prints, marked = (batch.column(i).to_pylist() for i in (1, 2, 3))
            drawn = list(zip(*(batch.column(i).to_pylist() for i in range(4, 8))))
            copies: dict[tuple, int] = {}
            for pair in zip(keys, prints):
                copies[pair] = copies.get(pair, 0) + 1
            for chunk in chunks(batch.column(0)):
                ends = np.flatnonzero(chunk.data == 10) + 1
                signs = np.zeros(len(chunk.data) + 1, np.int64)
                np.cumsum((chunk.data & 0xC0) != 0x80, out=signs[1:])  # code points before a byte
                raw = chunk.data.tobytes()
                for row in range(chunk.last - chunk.first):
                    at = chunk.first + row
                    key, mark = keys[at], prints[at]
                    times = copies.pop((key, mark), 0)
                    if not times:
                        continue
                    h = drawn[at]
                    empty = chunk.bounds[row] == chunk.bounds[row + 1]
                    plain = bool(empty or marked[at] or h[2] % 100 >= rate)
                    n, parts, edges = _cut(chunk, row, ends, h, limit, plain)
                    form, chars = PLAIN, (None, None)
                    if edges:
                        form = SPM if h[3] % 100 < spm_rate else PSM
                        chars = tuple(int(signs[y] - signs[x]) for x, y in zip(edges, edges[1:]))
                        order = (2, 0, 1) if form == SPM else (0, 2, 1)
                        parts = [parts[i] for i in order]
                    yield from out.add(key, mark, task, 0, None, n, form, *chars, times)
                    position = 0
                    for name, runs in parts:
                        for i, (x, y) in enumerate(runs):
                            position += 1
                            piece = (b"" if i else name) + raw[x:y]
                            yield from out.add(
                                key, mark, task, position, piece, *[None] * 5, size=len(piece)
                            )
        yield from out.rest()

    return run


def _arrow_kinds(schema: StructType, key: pa.DataType) -> list[pa.DataType]:
    kinds = {
        LongType(): pa.int64(), IntegerType(): pa.int32(), StringType(): pa.string(),
        BinaryType(): pa.binary(),
    }
    return [key, *(kinds[f.dataType] for f in schema.fields[1:])]


def _schema(key: StructField, **columns) -> StructType:
    return StructType([StructField("doc", key.dataType)] + [StructField(*c) for c in columns.items()])


def pieces(
    df: DataFrame, key: str = "doc_id", text: str = "text", *, seed: int = SEED, rate: int = RATE,
    spm_rate: int = SPM_RATE, piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """The outputs in pieces: partitions hold whole documents, sorted by document and ``position``.

    ``doc``, ``fingerprint`` and ``task`` name a document, ``piece`` holds bytes of its output. The row at
    position 0 holds no piece but ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and
    ``copies``, the number of rows that the document stands for.
    """
    schema = _schema(
        df.schema[key], fingerprint=BinaryType(), task=IntegerType(), position=LongType(),
        piece=BinaryType(), n=LongType(), form=StringType(), prefix_chars=LongType(),
        middle_chars=LongType(), copies=LongType(),
    )
    content = F.coalesce(F.col(text), F.lit(""))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | content.contains(mark)
    read = df.select(
        F.col(text), F.col(key), F.unhex(F.md5(content.cast("binary"))), marked, *draws(key, seed)
    ).toDF("text", "doc", "fingerprint", "marked", "h1", "h2", "h3", "h4")
    kinds = _arrow_kinds(schema, _arrow_type(df, key))
    emitted = read.mapInArrow(_emit(kinds, schema, piece_bytes, rate, spm_rate), schema)
    return emitted.repartition(*_DOCUMENT).sortWithinPartitions(*_DOCUMENT, "position")


def _arrow_type(df: DataFrame, key: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[key].dataType)


def _grouped(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    """Rows of sorted batches as ``(is the first of its document, document, *columns)``."""
    seen = None
    for batch in batches:
        documents = zip(*(batch.column(c).to_pylist() for c in _DOCUMENT))
        for row in zip(documents, *(batch.column(c).to_pylist() for c in columns)):
            yield row[0] != seen, *row
            seen = row[0]


_HEAD = ["n", "form", "prefix_chars", "middle_chars", "copies"]


def _digest_output(kinds: list[pa.DataType], schema: StructType):
    """Sorted pieces into digests of the outputs, and pieces placed as in the text.

    A task's copies of a document may come from several batches; their heads add up, of equal pieces one
    counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(schema, kinds)
        document, head, digest, copies, segment, last = None, None, None, 0, 0, 0

        def end() -> Iterator[pa.RecordBatch]:
            if document is not None:
                tail = (*head[:4], copies, digest.hexdigest())
                yield from out.add(*document, _END, None, *tail)

        for first, own, position, piece, *told in _grouped(batches, ["position", "piece", *_HEAD]):
            if first:
                yield from end()
                document, head, digest, copies, segment, last = own, told, hashlib.sha256(), 0, 0, 0
            if position == 0:
                copies += told[-1]
            elif position > last:
                last = position
                digest.update(piece)
                mark = piece[:MARK_BYTES]
                if head[1] != PLAIN and mark in MARKS:
                    segment, piece = MARKS[mark], piece[MARK_BYTES:]
                place = (segment << 48) + position
                yield from out.add(*own, place, piece, *[None] * 6, size=len(piece))
        yield from end()
        yield from out.rest()

    return run


def _digest_restored(kinds: list[pa.DataType], schema: StructType):
    """Pieces in the text's order into the rows of their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest = _Rows(schema, kinds), None
        names = ["place", "piece", *_HEAD, "output_sha256"]
        for first, own, place, piece, *told in _grouped(batches, names):
            digest = hashlib.sha256() if first else digest
            if place < _END:
                digest.update(piece)
                continue
            restored = digest.hexdigest()
            for _ in range(told[4]):
                yield from out.add(own[0], *told[:4], told[5], restored)
        yield from out.rest()

    return run


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per row of the documents: ``n``, ``form``, ``prefix_chars``, ``middle_chars``,
    ``output_sha256``, and ``restored_sha256`` of the text that follows from output and form."""
    doc, arrow = found.schema["doc"], _arrow_type(found, "doc")
    placed = _schema(
        doc, fingerprint=BinaryType(), task=IntegerType(), place=LongType(), piece=BinaryType(),
        n=LongType(), form=StringType(), prefix_chars=LongType(), middle_chars=LongType(),
        copies=LongType(), output_sha256=StringType(),
    )
    told = _schema(
        doc, n=LongType(), form=StringType(), prefix_chars=LongType(), middle_chars=LongType(),
        output_sha256=StringType(), restored_sha256=StringType(),
    )
    in_text = found.mapInArrow(_digest_output(_arrow_kinds(placed, arrow), placed), placed)
    # The partitions still hold whole documents, so no shuffle is needed for the other order.
    again = in_text.sortWithinPartitions(*_DOCUMENT, "place")
    rows = again.mapInArrow(_digest_restored(_arrow_kinds(told, arrow), told), told)
    return rows.withColumnRenamed("doc", key)


def texts(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per row of the documents: ``form`` and the whole ``output``."""
    schema = _schema(found.schema["doc"], form=StringType(), output=StringType())
    kinds = _arrow_kinds(schema, _arrow_type(found, "doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(schema, kinds)
        document, form, copies, last, parts = None, None, 0, 0, []

        def end() -> Iterator[pa.RecordBatch]:
            whole = b"".join(parts).decode()
            for _ in range(copies):
                yield from out.add(document[0], form, whole, size=len(whole))

        for first, own, position, piece, *told in _grouped(batches, ["position", "piece", *_HEAD]):
            if first:
                yield from end()
                document, form, copies, last, parts = own, told[1], 0, 0, []
            if position == 0:
                copies += told[-1]
            elif position > last:
                last = position
                parts.append(piece)
        yield from end()
        yield from out.rest()

    return found.mapInArrow(run, schema).withColumnRenamed("doc", key)


def restore(output: str, form: str) -> str:
    """The text from one output and its form."""
    if form == PLAIN:
        return output
    marks = {mark: output.index(mark) for mark in (PREFIX, SUFFIX, MIDDLE)}
    ends = sorted([*marks.values(), len(output)])
    return "".join(
        output[marks[m] + MARK_BYTES : ends[ends.index(marks[m]) + 1]] for m in (PREFIX, MIDDLE, SUFFIX)
    )
