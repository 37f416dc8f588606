"""The n-gram join, components and repeated passages against plain versions."""

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedloom.llm import ngram_join, queries, repeats, substring_index, suffix_dedup
from feedloom.llm.components import components
from feedloom.llm.tables import table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    rows = table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text) for r in rows)


def _groups(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_join(clashing, tricky):
    found = ngram_join.similar_groups(clashing)
    assert found.count() == len(tricky) + 1
    assert _groups(found) == brute.groups(tricky)


def test_join_splits_large_regions_and_cells(clashing, tricky):
    found = ngram_join.similar_groups(clashing, region_members=2, cell_elements=300, pivots=2)
    assert _groups(found) == brute.groups(tricky)


def test_join_query(spark, documents):
    assert _groups(queries.op1_ngram_join(spark, SF_DIR)) == brute.groups(documents)


def test_join_of_nothing(empty):
    assert ngram_join.similar_groups(empty).collect() == []


def test_join_null_key(spark):
    df = spark.createDataFrame([(None, "a b c"), (2, "a b c"), (1, "a b c")], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.similar_groups(df).collect()}
    assert found == {None: None, 1: 1, 2: 1}


@pytest.mark.parametrize("seed", range(4))
def test_link_finds_every_component(seed):
    rng = np.random.default_rng(seed)
    members = []
    for _ in range(12):
        base = rng.integers(0, 2**62, rng.integers(1, 80)).astype(np.uint64)
        for _ in range(rng.integers(1, 25)):
            keep = rng.random(len(base)) > rng.uniform(0, 0.25)
            own = np.unique(np.append(base[keep], base[:1]))
            members.append(own)
    everyone = np.arange(len(members))
    forest = ngram_join.Forest(len(members))
    ngram_join.link(ngram_join.Sets(members, 75), everyone, forest)
    plain = ngram_join.Forest(len(members))
    for i in everyone:
        for j in range(i):
            same = len(np.intersect1d(members[i], members[j]))
            if 100 * same >= 75 * (len(members[i]) + len(members[j]) - same):
                plain.join(i, np.array([j]))
    assert (forest.roots(everyone) == plain.roots(everyone)).all()


def test_components(spark):
    links = spark.createDataFrame(
        [(5, 4), (4, 3), (3, 9), (9, 9), (20, 21), (21, 20), (None, 1), (7, None), (30, 31), (31, 32)],
        "a long, b long",
    )
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {3: 3, 4: 3, 5: 3, 9: 3, 20: 20, 21: 20, 30: 30, 31: 30, 32: 30}


def test_repeated_words(clashing, tricky):
    found = substring_index.remove_repeats(clashing).collect()
    assert len(found) == len(tricky) + 1
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in found} == brute.kept_words(tricky)


def test_repeated_words_query(spark, documents):
    found = queries.op7_substring_dedup(spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == {
        k: (n, gone, brute.sha(kept)) for k, (n, gone, kept) in brute.kept_words(documents).items()
    }


def test_repeated_bytes(clashing, tricky):
    found = suffix_dedup.remove_repeats(clashing).collect()
    assert len(found) == len(tricky) + 1
    assert {
        r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found
    } == brute.kept_bytes(tricky)


def test_repeated_bytes_query(spark, documents):
    found = queries.op8_suffix_dedup(spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == {
        k: (n, gone, runs, brute.sha(kept))
        for k, (n, gone, runs, kept) in brute.kept_bytes(documents).items()
    }


@pytest.mark.parametrize("remove", [substring_index.remove_repeats, suffix_dedup.remove_repeats])
def test_repeats_of_nothing_and_null_keys(spark, empty, remove):
    assert remove(empty).collect() == []
    text = " ".join(f"word{i}" for i in range(80))
    df = spark.createDataFrame([(None, text), (1, text), (1, text), (2, text)], "doc_id long, text string")
    found = remove(df).select("doc_id", F.col("n_removed") > 0).collect()
    assert sorted(map(tuple, found), key=repr) == [(1, False), (1, False), (2, True), (None, False)]


def _bounded(search, most):
    def run(symbols, bounds, doc):
        assert len(symbols) <= most, f"an index of {len(symbols)} symbols"
        return search(symbols, bounds, doc)

    return run


@pytest.mark.parametrize("kind, search", [
    (repeats.of_words(), substring_index.search), (repeats.of_bytes(), suffix_dedup.search),
])
def test_a_line_of_very_many_documents_is_not_searched_in_one_index(spark, kind, search):
    """A line shorter than a window, in different surroundings, and two documents that repeat."""
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))

    def own(n):
        return ["".join(w) for w in letters[rng.integers(0, 26, (n, 6))]]

    line = own(45) if kind.name == "words" else own(5)
    docs = [(i, " ".join(own(25) + line + own(25))) for i in range(20_000)]
    docs += [(30_000, docs[70][1]), (30_001, "x " + docs[9_000][1] + " y")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(16)
    guarded = _bounded(search, 2 * repeats.INDEX_SYMBOLS)
    found = repeats.with_repeats(df, kind, guarded, "doc_id", "text", ["doc_id"])
    spans = {
        r._0: [(int(a), int(b)) for a, b in zip(*repeats.spans_from_bytes(r.repeated))]
        for r in found.where("repeated is not null").collect()
    }
    sizes = [95 if kind.name == "words" else len(docs[i][1]) for i in (70, 9_000)]
    before = 1 if kind.name == "words" else 2
    assert spans == {30_000: [(0, sizes[0])], 30_001: [(before, before + sizes[1])]}


def test_contents_of_one_anchor_are_told_apart_by_all_bits():
    """Two documents' contents that differ in the low 24 bits only are a contest, not a repeat."""
    column = lambda *values: np.array(values, np.int64)
    content = np.array([5 << 40, (5 << 40) + 1], np.uint64)
    occ = repeats.Occurrences(
        column(0, 1), column(3, 9), column(1, 1), np.full(2, 7 << 40, np.uint64), content
    )
    batch = repeats._packed(column(1, 2), column(11, 12), occ, 1)
    found = repeats._resolve(repeats.of_words())(pa.Table.from_batches([batch])).to_pylist()
    assert [(r["row_key"], r["repeated"], len(r["contested"])) for r in found] == [
        (11, b"", repeats._CONTEST.itemsize), (12, b"", repeats._CONTEST.itemsize)
    ]


@pytest.mark.parametrize("frequent", [2, 6, 40])
def test_repeats_with_frequent_slices(spark, clashing, tricky, frequent):
    for kind, search, plain in (
        (repeats.of_words(), substring_index.search, brute.repeated(tricky, brute.SPACED.findall)),
        (repeats.of_bytes(), suffix_dedup.search, brute.repeated(tricky, lambda t: list(t.encode()))),
    ):
        found = repeats.with_repeats(clashing, kind, search, "doc_id", "text", ["doc_id"], frequent)
        for r in found.collect():
            hit = np.zeros(len(plain[r._0][0]), bool)
            for a, b in zip(*repeats.spans_from_bytes(r.repeated or [])):
                hit[a:b] = True
            assert (hit == plain[r._0][1]).all()


@pytest.mark.parametrize("module, dtype", [(substring_index, "u8"), (suffix_dedup, "u1")])
def test_search(module, dtype):
    rng = np.random.default_rng(8)
    for size in (3, 200):
        base = rng.integers(0, size, 400)
        parts = []
        for i in range(14):
            low = rng.integers(0, 300)
            own = base[low : low + rng.integers(50, 100)].copy()
            if i % 2:
                own[rng.integers(0, len(own))] = rng.integers(0, size)
            parts.append(own.astype(dtype))
        doc = rng.integers(0, 8, len(parts))
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        hit = module.search(np.concatenate(parts), bounds, doc)
        for i, own in enumerate(parts):
            for at in range(len(own)):
                window = own[at : at + 50]
                earlier = len(window) == 50 and any(
                    doc[j] < doc[i] and window.tobytes() in other.tobytes()
                    and any(
                        (other[k : k + 50] == window).all() for k in range(len(other) - 49)
                    )
                    for j, other in enumerate(parts)
                )
                assert hit[bounds[i] + at] == earlier
