"""Work that grows faster than the corpus: what chance puts into several documents is set aside early."""

import brute
import numpy as np
import pytest

import corpus_pipeline
from feedloom.llm import ngram_join, repeats, substring_index, suffix_dedup
from feedloom.llm.arrays import BYTE_CODES


@pytest.fixture(scope="module")
def by_chance():
    """(doc_id, text): documents that share a quarter of their sentences with few others; of them some have copies."""
    rng = np.random.default_rng(11)

    def sentence():
        return " ".join(f"w{i}" for i in rng.integers(0, 10**6, 20))

    common = [sentence() for _ in range(300)]
    docs = []
    for key in range(240):
        own = [sentence() for _ in range(9)] + [common[i] for i in rng.integers(0, 300, 3)]
        docs.append((key, " ".join(own[i] for i in rng.permutation(12))))
    for key in range(6):
        docs.append((300 + key, docs[key][1] + " once more"))
        docs.append((400 + key, docs[key][1]))
    return docs


@pytest.fixture
def compared(monkeypatch):
    """The number of pairs that each call of the coarse join gets."""
    seen = []
    coarse = ngram_join.coarse_links

    def spy(pairs, *others):
        seen.append(pairs.count())
        return coarse(pairs, *others)

    monkeypatch.setattr(ngram_join, "coarse_links", spy)
    return seen


def test_join_compares_no_documents_that_only_share_sentences(spark, by_chance, compared):
    df = spark.createDataFrame(by_chance, "doc_id long, text string").repartition(5)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_groups(df).collect()}
    assert found == brute.groups(by_chance)
    assert len(compared) == 1 and 6 <= compared[0] < 30


def test_stage_near_duplicates_compares_no_documents_that_only_share_sentences(
    spark, by_chance, compared
):
    rows = [(key, text, "en", "web", len(text)) for key, text in by_chance]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.near_duplicates(spark, df, "")
    assert sorted(r.doc_id for r in found.collect()) == list(range(240))
    assert len(compared) == 1 and 6 <= compared[0] < 30


def _bounded(search, most):
    def run(symbols, bounds, doc):
        assert len(symbols) <= most, f"an index of {len(symbols)} symbols"
        return search(symbols, bounds, doc)

    return run


@pytest.mark.parametrize("kind, search, shared, taken_apart, glue", [
    (repeats.of_words(), substring_index.search, 22, brute.SPACED.findall, " "),
    (repeats.of_bytes(), suffix_dedup.search, 5, lambda t: list(t.encode()), " "),
])
def test_phrases_shorter_than_a_window_are_not_searched(spark, kind, search, shared, taken_apart, glue):
    """Short phrases of a few documents each, and three documents that share a passage in part."""
    rng = np.random.default_rng(6)

    def own(n):
        return [f"{i:05d}" for i in rng.integers(0, 10**5, n)]

    phrases = [own(shared) for _ in range(60)]
    docs = []
    for key in range(150):
        words = own(30)
        for i in rng.integers(0, 60, 3):
            words += phrases[i] + own(30)
        docs.append((key, glue.join(words)))
    passage = own(80)
    for key, (low, high) in enumerate([(0, 70), (5, 80), (2, 62)]):
        docs.append((200 + key, glue.join(own(20) + passage[low:high] + own(20))))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    guarded = _bounded(search, 2_000)
    plain = brute.repeated(docs, taken_apart)
    found = repeats.with_repeats(df, kind, guarded, "doc_id", "text", ["doc_id"]).collect()
    assert len(found) == len(docs)
    for r in found:
        hit = np.zeros(len(plain[r._0][0]), bool)
        for a, b in zip(*repeats.spans_from_bytes(r.repeated or [])):
            hit[a:b] = True
        assert (hit == plain[r._0][1]).all()


def test_spans_by_row_are_the_merged_spans_of_each_row():
    rng = np.random.default_rng(2)
    key, start = rng.integers(-9, 9, 300), rng.integers(0, 2_000, 300)
    stop = start + rng.integers(1, 60, 300)
    keys, blobs = repeats.spans_by_row(key, start, stop)
    expected = {
        int(k): repeats.spans_to_bytes(*repeats.merge_spans(start[key == k], stop[key == k]))
        for k in np.unique(key)
    }
    assert dict(zip(keys.tolist(), blobs.to_pylist())) == expected


def test_a_window_is_met_at_its_anchor_from_either_side():
    """Windows that hold the anchor at their first or last symbols only, in different surroundings."""
    kind = repeats.of_bytes()
    rng = np.random.default_rng(3)
    text = rng.integers(97, 123, 400).astype("u1")
    for at in range(0, 300, 7):
        for more in (0, 1, 9):
            shared = text[at : at + 50 + more]
            around = [rng.integers(97, 123, 40).astype("u1") for _ in range(4)]
            whole = [np.concatenate([around[0], shared, around[1]]), np.concatenate([around[2], shared, around[3]])]
            bounds = np.array([0, len(whole[0]), len(whole[0]) + len(whole[1])])
            occ = repeats.occurrences(BYTE_CODES[np.concatenate(whole)], bounds, kind)
            for window in range(40, 41 + more):
                a, b = (
                    np.flatnonzero((occ.row == row) & (occ.start <= window) & (window < occ.start + occ.count))[0]
                    for row in (0, 1)
                )
                assert occ.anchor[a] == occ.anchor[b]
                assert any(side[a] == side[b] > 0 for side in (occ.left, occ.right))
