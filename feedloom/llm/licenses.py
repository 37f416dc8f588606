"""License scans: MinHash bands over overlapping windows retrieve templates, shingles verify them.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. For a template of ``l`` words a text is cut
into windows of ``l + s`` words, ``s = ceil(l / 2)`` apart, so some window holds all of any place where
the template stands. If such a window contains 75 % of the template's ``m`` shingles of five words, its
Jaccard similarity with the template is at least ``0.75 m / (l + s - 4 + 0.25 m)``; the number of bands
(of one MinHash each) is chosen so that all of them miss with a probability of at most ``MISS``.

A band of a window meets a template's when the shingle with the template's smallest hash is also the
window's, so windows are only hashed where they hold such a shingle; this changes no result. Templates
that a band retrieves are verified by exact containment. A template of fewer than five words has its whole
sequence as one shingle, and windows are compared with that.

The band tables of all templates are one: from each smallest shingle to the templates that have it. A text
is looked up in it once, and only templates that it names are tried, however many there are.

For every row and template the best window is returned: the highest containment, then the first. Null and
empty texts have none, and so has an empty table. Very long texts are cut into windows whole. Rows are
independent: repeated rows, nulls and further columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.arrays import chunks, expand, mix, word_codes, words
from feedloom.llm.license_texts import TEMPLATES

N = 5
PERCENT = 75
MISS = 1e-6
_U = np.uint64

def _shingles(codes: np.ndarray, n: int) -> np.ndarray:
    size = max(0, len(codes) - n + 1)
    whole = np.zeros(size, _U)
    for k in range(n):
        whole = mix(whole * _U(0x9E3779B97F4A7C15) + codes[k : k + size])
    return whole


def _hash(shingles: np.ndarray, band: int) -> np.ndarray:
    return mix(shingles ^ mix(np.array([band + 1], _U)))


class Template:
    """A template's shingles, windows and the smallest shingle of each band."""

    def __init__(self, name: str, text: str):
        chunk = next(chunks(pa.array([text])))
        found = words(chunk)
        codes = word_codes(chunk, found, fold=True)
        if not len(codes):
            raise ValueError(f"template without words: {name}")
        self.name, self.length = name, len(codes)
        self.n = min(N, len(codes))
        self.shingles = np.unique(_shingles(codes, self.n))
        self.step = -(-self.length // 2)
        self.window = self.length + self.step
        m = len(self.shingles)
        share = PERCENT / 100
        self.similarity = share * m / (self.window - self.n + 1 + (1 - share) * m)
        self.bands = math.ceil(math.log(MISS) / math.log(1 - self.similarity))
        lowest = [_hash(self.shingles, band).argmin() for band in range(self.bands)]
        self.smallest = self.shingles[lowest]
        self.marks = np.unique(self.smallest)

    def matches(self, shingles: np.ndarray, n_words: int) -> tuple[float, int, int] | None:
        """The best window of a text's shingles: containment, first word and end."""
        best = None
        places = np.flatnonzero(np.isin(shingles, self.marks))
        if not len(places):
            return None
        last = max(0, -(-(n_words - self.window) // self.step))
        tried: set[int] = set()
        for place in places.tolist():
            low = max(0, (place + self.n - self.window + self.step - 1) // self.step)
            for number in range(low, min(place // self.step, last) + 1):
                if number in tried:
                    continue
                tried.add(number)
                start = number * self.step
                own = shingles[start : start + self.window - self.n + 1]
                if not self._retrieved(own):
                    continue
                held = np.isin(own, self.shingles)
                same = len(np.unique(own[held]))
                if 100 * same >= PERCENT * len(self.shingles):
                    inside = np.flatnonzero(held)
                    found = (
                        same / len(self.shingles), start + int(inside[0]),
                        start + int(inside[-1]) + self.n,
                    )
                    if best is None or (-found[0], found[1]) < (-best[0], best[1]):
                        best = found
        return best

    def _retrieved(self, own: np.ndarray) -> bool:
        """Whether any band of the window equals the template's."""
        own = np.unique(own)
        for band in np.flatnonzero(np.isin(self.smallest, own)).tolist():
            if own[_hash(own, band).argmin()] == self.smallest[band]:
                return True
        return False


class BandTable:
    """Smallest shingles of all templates with shingles of ``n`` words, and whose they are."""

    def __init__(self, known: list[Template], n: int):
        own = [(i, t) for i, t in enumerate(known) if t.n == n]
        marks = np.concatenate([t.marks for _, t in own])
        owner = np.repeat([i for i, _ in own], [len(t.marks) for _, t in own])
        order = np.argsort(marks, kind="stable")
        self.marks, first = np.unique(marks[order], return_index=True)
        self.owner, self.bounds = owner[order], np.append(first, len(order))

    def named(self, shingles: np.ndarray, row_bounds: np.ndarray) -> np.ndarray:
        """Pairs (row, template) of rows that hold a mark of a template, as rows of a matrix."""
        at = np.searchsorted(self.marks, shingles)
        at[at == len(self.marks)] = 0
        hit = np.flatnonzero(self.marks[at] == shingles)
        row, at = np.searchsorted(row_bounds, hit, "right") - 1, at[hit]
        many = self.bounds[at + 1] - self.bounds[at]
        owner = self.owner[expand(self.bounds[at], many)]
        return np.unique(np.stack([np.repeat(row, many), owner], axis=1), axis=0)


def scan(
    df: DataFrame, templates: dict[str, str] | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, template, containment, first_word, end_word)`` of every template found in a row.

    ``templates`` is an argument and goes to all tasks; the texts of a few thousand licenses at most.
    """
    known = [Template(name, body) for name, body in (templates or TEMPLATES).items()]
    tables = {n: BandTable(known, n) for n in sorted({t.n for t in known})}
    kind = df.schema[key].dataType.simpleString()
    schema = f"_key {kind}, template string, containment double, first_word int, end_word int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, names, found = [], [], []
            for chunk in chunks(batch.column(1)):
                cut = words(chunk)
                codes = word_codes(chunk, cut, fold=True)
                for n, bands in tables.items():
                    whole = _shingles(codes, n)
                    for row, i in bands.named(whole, cut.bounds).tolist():
                        low, high = cut.bounds[row], cut.bounds[row + 1]
                        own = whole[low : max(low, high - n + 1)]
                        best = known[i].matches(own, high - low) if len(own) else None
                        if best:
                            rows.append(chunk.first + row)
                            names.append(known[i].name)
                            found.append(best)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(names, pa.string()),
                 pa.array([f[0] for f in found], pa.float64()),
                 pa.array([f[1] for f in found], pa.int32()),
                 pa.array([f[2] for f in found], pa.int32())],
                ["_key", "template", "containment", "first_word", "end_word"],
            )

    picked = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return picked.mapInArrow(run, schema).withColumnRenamed("_key", key)
