"""SentencePiece encoding that keeps the original byte span of every piece, and decoding.

Encoding has three steps:

1. Normalisation. The model's compiled character map is a trie of source strings; at each place the
   longest matching source is replaced, and every normalised byte records the original byte it came
   from. Spaces become the model's space mark after that.
2. Merging. The normalised text falls into units that no piece can span (a run of space marks with
   the word after it, or a line break), which is checked against the model's vocabulary. Units repeat,
   so each distinct one is merged once by the library and remembered.
3. Projection. A piece covers so many normalised bytes; the recorded alignment gives its original
   bytes.

Null texts count as empty and give no pieces. Rows are independent: repeated rows, nulls in other
columns and further columns do not matter; only the key and text columns are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, IntegerType, StringType, StructField, StructType,
)
from sentencepiece import sentencepiece_model_pb2

from feedloom.llm.arrays import BYTE_CODES, chunks, expand, rolling

SPACE_MARK = "▁"
KEPT_UNITS = 400_000
ROWS_AT_A_TIME = 256
OUTPUTS = {
    "ids": (ArrayType(IntegerType()), pa.list_(pa.int32())),
    "begins": (ArrayType(IntegerType()), pa.list_(pa.int32())),
    "ends": (ArrayType(IntegerType()), pa.list_(pa.int32())),
    "decoded": (StringType(), pa.string()),
}


class CharacterMap:
    """A compiled character map: a double-array trie of source strings and their replacements."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self.targets = compiled[4 + size :]

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """The longest source string that starts at a byte: its length and its replacement."""
        units, found = self.units, None
        node = self._offset(units[0])
        for i in range(at, len(source)):
            node ^= source[i]
            unit = units[node]
            if unit & 0x800000FF != source[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                value = units[node] & 0x7FFFFFFF
                found = i + 1 - at, self.targets[value : self.targets.index(b"\0", value)]
        return found

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


def _shown(piece) -> bytes:
    if piece.type == 6:  # a byte
        return bytes([int(piece.piece[3:5], 16)])
    if piece.type == 3:  # a control mark
        return b""
    if piece.type == 2:  # unknown
        return " \u2047 ".encode()
    return piece.piece.replace(SPACE_MARK, " ").encode()


class Pieces:
    """A model file: its normalisation, its vocabulary, and what it made of units so far."""

    def __init__(self, model_file: str):
        with open(model_file, "rb") as file:
            proto = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self._set_rules(proto.normalizer_spec)
        marks = [p.piece for p in proto.pieces if p.type in (1, 4)]
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) or ("\n" in p and p != "\n") for p in marks):
            raise ValueError("pieces of this model span words; units cannot be merged apart")
        # Bytes of normalised text that each id stands for.
        self.widths = np.array(
            [1 if p.type == 6 else len(p.piece.encode()) for p in proto.pieces], np.int32
        )
        # Units go through the library after normalisation, so they must not be changed again.
        plain = sentencepiece_model_pb2.ModelProto()
        plain.CopyFrom(proto)
        plain.normalizer_spec.precompiled_charsmap = b""
        plain.normalizer_spec.add_dummy_prefix = False
        plain.normalizer_spec.remove_extra_whitespaces = False
        plain.normalizer_spec.escape_whitespaces = True
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=plain.SerializeToString())
        # What each id decodes to, one after another.
        shown = [_shown(p) for p in proto.pieces]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_bounds = np.concatenate([[0], np.cumsum([len(x) for x in shown])])
        self.leading = np.array([x[:1] == b" " and p.type != 6 for x, p in zip(shown, proto.pieces)])
        self._forget()

    def _set_rules(self, spec) -> None:
        compiled = spec.precompiled_charsmap
        self.map = CharacterMap(compiled) if compiled else None
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        if not spec.escape_whitespaces:
            raise ValueError("models without a space mark are not supported")

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text; the original byte of each of its bytes, and of its end."""
        source = text.encode()
        if self.map is None and not self.squeeze:
            at = np.frombuffer(source, np.uint8)
            where = np.repeat(np.arange(len(at)), np.where(at == 32, 3, 1))
            head = [0, 0, 0] if self.prefix and source else []
            normal = (SPACE_MARK if head else "") + text.replace(" ", SPACE_MARK)
            return normal, np.concatenate([head, where, [len(source)]]).astype(np.int64)
        out, where, i = bytearray(), [], 0
        while i < len(source):
            found = self.map.longest(source, i) if self.map else None
            if found is None:
                lead = source[i]
                width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                found = width, source[i : i + width]
            out += found[1]
            where += [i] * len(found[1])
            i += found[0]
        if self.squeeze:
            out, where, i = self._squeezed(out, where, i)
        mark = SPACE_MARK.encode()
        joined, places = bytearray(), []
        if self.prefix and out:
            joined += mark
            places += [where[0]] * 3
        for byte, place in zip(out, where):
            joined += mark if byte == 32 else bytes([byte])
            places += [place] * (3 if byte == 32 else 1)
        return joined.decode(), np.array([*places, i], np.int64)

    @staticmethod
    def _squeezed(out: bytearray, where: list[int], end: int):
        """Without spaces at the ends, and with one where several stood."""
        kept = [
            i for i, byte in enumerate(out) if byte != 32 or (i and out[i - 1] != 32)
        ]
        while kept and out[kept[-1]] == 32:
            end = where[kept.pop()]
        return bytearray(out[i] for i in kept), [where[i] for i in kept], end

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.numbers = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)
        self.bounds = np.zeros(1, np.int64)

    def _learn(self, keys: np.ndarray, units: list[str]) -> None:
        """Merge units that were not seen before."""
        found = self.merger.encode(units, num_threads=1)
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), np.int32)])
        widths = np.fromiter(map(len, found), np.int64, len(found))
        first = len(self.bounds) - 1
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(widths)])
        known = np.concatenate([self.known, keys])
        order = np.argsort(known, kind="stable")
        numbers = np.concatenate([self.numbers, np.arange(first, first + len(keys))])
        self.known, self.numbers = known[order], numbers[order]

    def merge(self, normal: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of normalised texts: their ids one after another, and each text's bounds.

        Space marks are spaces here. Units are told apart by 64-bit hashes.
        """
        for chunk in chunks(normal):
            if len(self.known) > KEPT_UNITS:
                self._forget()
            data = chunk.data
            space, line = data == 32, data == 10
            opens = space | line
            opens[1:] = (space[1:] & ~space[:-1]) | line[1:] | (line[:-1] & ~space[1:])
            edges = chunk.bounds[:-1]
            opens[edges[edges < len(data)]] = True
            start = np.flatnonzero(opens)
            stop = np.append(start[1:], len(data))
            hashes = rolling(BYTE_CODES[data]).hashes(start, stop)
            keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            place = np.searchsorted(self.known, keys)
            place[place == len(self.known)] = 0
            new = self.known[place] != keys if len(self.known) else np.ones(len(keys), bool)
            if new.any():
                raw = data.tobytes()
                units = [raw[start[i] : stop[i]].decode() for i in first[new]]
                self._learn(keys[new], units)
                place = np.searchsorted(self.known, keys)
            numbers = self.numbers[place][which]
            widths = self.bounds[numbers + 1] - self.bounds[numbers]
            ids = self.flat[expand(self.bounds[numbers], widths)]
            ends = np.concatenate([[0], np.cumsum(widths)])
            yield ids, ends[np.searchsorted(start, chunk.bounds)]

    def encode(self, texts: pa.Array, outputs: tuple[str, ...]) -> dict[str, list]:
        """The asked outputs for each text."""
        spans = "begins" in outputs or "ends" in outputs
        where: list[np.ndarray] = []
        if spans or self.map is not None or self.squeeze:
            both = [self.normalise(t or "") for t in texts.to_pylist()]
            where = [w for _, w in both]
            normal = pa.array([n.replace(SPACE_MARK, " ") for n, _ in both], pa.string())
        else:
            normal = pc.replace_substring(pc.fill_null(texts, ""), SPACE_MARK, " ")
            if self.prefix:
                led = pc.binary_join_element_wise("", normal, " ")
                normal = pc.if_else(pc.equal(normal, ""), "", led)
        out: dict[str, list] = {name: [] for name in outputs}
        row = 0
        for flat, bounds in self.merge(normal):
            ids = np.split(flat, bounds[1:-1])
            if "ids" in out:
                out["ids"] += ids
            for x in ids if spans else []:
                ends, at = np.cumsum(self.widths[x]), where[row]
                if "begins" in out:
                    out["begins"].append(at[np.append(0, ends)[: len(x)]])
                if "ends" in out:
                    out["ends"].append(at[ends])
                row += 1
            if "decoded" in out:
                out["decoded"] += self.decode_flat(flat, bounds)
        return out

    def decode_flat(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The text of each slice of ids: their pieces' bytes, without the space put in front."""
        widths = self.shown_bounds[ids + 1] - self.shown_bounds[ids]
        data = self.shown[expand(self.shown_bounds[ids], widths)]
        ends = np.concatenate([[0], np.cumsum(widths)])[bounds]
        out = []
        for first, last, a, b in zip(bounds, bounds[1:], ends, ends[1:]):
            if self.prefix and first < last and self.leading[ids[first]]:
                a += 1
            raw = data[a:b].tobytes()
            try:
                out.append(raw.decode())
            except UnicodeDecodeError:  # byte pieces that make no character
                out.append(self.library.decode(ids[first:last].tolist()))
        return out


@functools.lru_cache(maxsize=2)
def pieces(model_file: str) -> Pieces:
    return Pieces(model_file)


def _lists(values: list[np.ndarray]) -> pa.Array:
    bounds = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=bounds[1:])
    flat = np.concatenate(values).astype(np.int32) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))


def encode(
    df: DataFrame, model_file: str, key: str = "doc_id", text: str = "text",
    outputs: tuple[str, ...] = ("ids", "begins", "ends"),
) -> DataFrame:
    """The key column and the asked outputs of every row.

    ``ids``: piece ids. ``begins`` and ``ends``: the original UTF-8 bytes of each piece. ``decoded``:
    the text the ids decode to. ``model_file`` is opened by every executor.
    """
    key_field = df.schema[key]
    schema = StructType(
        [StructField("_key", key_field.dataType)]
        + [StructField(name, OUTPUTS[name][0]) for name in outputs]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_file)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_A_TIME):
                part = batch.slice(at, ROWS_AT_A_TIME)
                found = model.encode(part.column(1), outputs)
                columns = [
                    pa.array(found[name], pa.string()) if name == "decoded" else _lists(found[name])
                    for name in outputs
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["_key", *outputs])

    picked = df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    return picked.mapInArrow(run, schema).withColumnRenamed("_key", key)


def decode(df: DataFrame, model_file: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """The key column and ``decoded``, the text that each row's ids stand for; null ids give ''."""
    schema = StructType(
        [StructField("_key", df.schema[key].dataType), StructField("decoded", StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_file)
        for batch in batches:
            lists = batch.column(1).to_pylist()
            ends = np.cumsum([0, *(len(x or ()) for x in lists)])
            ids = np.fromiter(chain.from_iterable(x or () for x in lists), np.int32, ends[-1])
            shown = model.decode_flat(ids, ends)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shown, pa.string())], ["_key", "decoded"]
            )

    picked = df.select(F.col(key).alias("_key"), F.col(ids).alias("_ids"))
    return picked.mapInArrow(run, schema).withColumnRenamed("_key", key)
