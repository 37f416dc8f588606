"""Language, quality, pieces, neighbours and the pipeline."""

import brute
import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from feedloom.llm import language_id, nearest, quality, queries, sentence_pieces
from feedloom.llm.arrays import chunks
from feedloom.llm.tables import table

SF_DIR = "/root/testdata/sf0.01"
SMALL_DIR = "/root/testdata/sf0.001"


def test_language_accuracy(spark):
    found = queries.op6_language_id(spark, SF_DIR)
    truth = table(spark, SF_DIR, "documents").select("doc_id", "lang")
    assert found.count() == truth.count()
    judged = found.join(truth, "doc_id").where("held_out")
    right = judged.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    assert found.where("score < 0 OR score > 1 OR lang_pred IS NULL").count() == 0


def test_language_edges(spark, empty):
    assert language_id.fit(empty) is None
    assert language_id.predict(empty, None).collect() == []
    docs = spark.createDataFrame(
        [(1, None, "en"), (2, "", "en"), (3, "12 34 !?", "en"), (4, "the quick " * 90, "en"),
         (5, "der die das " * 9000, "de"), (6, "é", None), (6, "é", None)],
        "doc_id long, text string, lang string",
    )
    network = language_id.fit(docs)
    found = language_id.predict(docs.withColumn("score", F.lit("x")), network)
    rows = {r.doc_id: (r.lang_pred, r.score) for r in found.collect()}
    assert found.count() == 7
    assert all(rows[i] == ("und", 0) for i in (1, 2, 3))
    assert rows[4][0] == "en" and rows[5][0] == "de" and rows[6][0] in ("en", "de")
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}


def test_windows_cover_texts():
    texts = ["", "a" * 5, "b" * 128, "c" * 300]
    chunk = next(chunks(pa.array(texts)))
    windows, ends = language_id.cut(chunk.data, chunk.bounds)
    assert np.diff(ends).tolist() == [0, 1, 1, 3]
    assert windows[0].tobytes() == b"a" * 5 + bytes(123)
    assert all((w == ord("c")).all() for w in windows[2:])


def test_quality_on_held_out_rows(spark):
    found = queries.op5_quality(spark, SF_DIR)
    labels = table(spark, SF_DIR, "labels")
    assert found.count() == table(spark, SF_DIR, "documents").count()
    rows = found.where("held_out").join(labels, "doc_id").collect()
    right = np.mean([r.predicted == r.quality for r in rows])
    good = np.array([r.score for r in rows if r.quality == 1])
    bad = np.array([r.score for r in rows if r.quality == 0])
    assert right > 0.9
    assert (good[:, None] > bad[None]).mean() > 0.95


def test_quality_edges(spark, empty):
    none = empty.withColumn("good", F.lit(True)).withColumn("web", F.lit(True))
    assert quality.fit(none, none, "good", "web") is None
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "x" * 300_000), (4, "a b"), (4, "a b")], "doc_id long, text string"
    )
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}
    rng = np.random.default_rng(0)
    n = len(quality.FEATURES)
    scorer = quality.train(rng.normal(1, 1, (90, n)), rng.normal(-1, 1, (90, n)), 0.4, steps=60)
    rows = quality.score(docs, scorer).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert len({r.score for r in rows if r.doc_id == 4}) == 1


def test_prior_estimate():
    rng = np.random.default_rng(1)
    good = rng.normal(2, 1, (3000, 3))
    web = np.concatenate([rng.normal(2, 1, (2100, 3)), rng.normal(-2, 1, (900, 3))])
    assert abs(quality.estimate_prior(good, web) - 0.7) < 0.08


PIECE_TEXTS = [
    None, "", " ", "  a  b ", "\n\n x\n", "▁x", "a▁▁b", "日本 \U0001f600\t x", "<s> </s>", "a\x00b",
    "é e\u0301 ﬁ", "x" * 5000, "one\r\ntwo\n three", "Zu der\n\n\nund ", "a b " * 3000,
]


@pytest.fixture(scope="module")
def piece_texts(spark):
    docs = [r.text for r in table(spark, SMALL_DIR, "documents").select("text").collect()]
    return PIECE_TEXTS + docs


def test_pieces_are_the_library_s(spark, piece_texts):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    rows = list(enumerate(piece_texts))
    df = spark.createDataFrame([(*r, "x") for r in [*rows, rows[3]]], "doc_id long, text string, ids string")
    outputs = ("ids", "begins", "ends", "decoded")
    found = sentence_pieces.encode(df, queries.PIECE_MODEL, outputs=outputs)
    assert found.count() == len(rows) + 1
    for r in found.collect():
        text = piece_texts[r.doc_id] or ""
        assert list(r.ids) == library.encode(text)
        assert r.decoded == library.decode(list(r.ids))
        # Spans follow each other and cover the text.
        size = len(text.encode())
        assert not r.ids or (r.begins[0] == 0 and r.ends[-1] == size)
        assert list(r.begins[1:]) == list(r.ends[:-1])
    back = sentence_pieces.decode(found, queries.PIECE_MODEL).collect()
    assert {(r.doc_id, r.decoded) for r in back} == {(r.doc_id, r.decoded) for r in found.collect()}


def test_piece_spans_are_the_pieces_text():
    model = sentence_pieces.Pieces(queries.PIECE_MODEL)
    text = "Zwei  Öl\nund 日本 x"
    out = model.encode(pa.array([text]), ("ids", "begins", "ends"))
    raw = text.encode()
    for i, a, b in zip(out["ids"][0], out["begins"][0], out["ends"][0]):
        piece = model.library.id_to_piece(int(i))
        shown = raw[a:b]
        if piece.startswith("<0x"):
            assert shown == bytes([int(piece[3:5], 16)])
        else:
            assert shown.decode() == piece.replace("▁", " ") or (a == 0 and piece[1:] == shown.decode())


def test_invalid_bytes_decode_as_in_the_library():
    model = sentence_pieces.Pieces(queries.PIECE_MODEL)
    ids = [model.library.piece_to_id("<0xE6>"), model.library.piece_to_id("▁a"), 1, 0]
    shown = model.decode_flat(np.array(ids), np.array([0, 4]))
    assert shown == [model.library.decode(ids)]


def test_character_map_is_the_library_s(piece_texts):
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    proto = sentence_pieces.sentencepiece_model_pb2.ModelProto.FromString(
        normalizer.serialized_model_proto()
    )
    model = sentence_pieces.Pieces.__new__(sentence_pieces.Pieces)
    model._set_rules(proto.normalizer_spec)
    for text in [*(t or "" for t in piece_texts[:60]), "ﬁ Ａ①  ㍿ é  x ", "ｶﾞ① b\u200bc\t\td", "\u3000 x"]:
        normal, where = model.normalise(text)
        assert normal.replace("▁", " ").strip(" ") == normalizer.normalize(text).replace("▁", " ").strip(" ")
        assert len(where) == len(normal.encode()) + 1
        assert (np.diff(where) >= 0).all() and where[-1] <= len(text.encode())


def _plain_neighbours(rows, is_query, k):
    out = {}
    for name, vector in rows:
        if not is_query(name):
            continue
        scored = sorted(
            (float(np.sqrt(((np.array(v) - np.array(vector)) ** 2).sum())), other)
            for other, v in rows
            if other != name
        )
        out[name] = [(other, score) for score, other in scored[:k]]
    return out


def test_neighbours_edges(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(0, 3, 5).tolist()) for i in range(1, 9)] + [(100, [1.0, 0.0, 0.0, 0.0, 0.0])]
    good += [(200 + i, [1.0, 0.0, 0.0, 0.0, 0.0]) for i in range(30)]
    bad = [(300, None), (400, [0.0] * 5), (500, [1.0, None, 0.0, 0.0, 0.0]), (600, [float("nan")] * 5),
           (700, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (800, [1.0, 2.0]), (None, [1.0] * 5), (900, [])]
    rows = [*good, *bad, good[-1], good[0]]
    df = spark.createDataFrame(
        [(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, score string, part int"
    )
    # With all axes probed the result is exact.
    found = nearest.search(df, F.col("vec_id") % 100 == 0, k=10, tables=2, probes=16, part_rows=7)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == _plain_neighbours(good, lambda i: i % 100 == 0, 10)
    few = df.where("vec_id IN (1, 2, 100)")
    ranks = nearest.search(few, F.col("vec_id") == 100, tables=2, probes=16).collect()
    assert sorted(r["rank"] for r in ranks) == [1, 2]
    assert nearest.search(df.where("vec_id = 400"), F.lit(True)).collect() == []


def _neighbours(found):
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((r.vec_id, r.score))
    return got


def test_all_candidates_of_small_tables_and_outliers(spark):
    """With the production probes: eight candidates give eight rows; an outlier is answered in full."""
    rng = np.random.default_rng(7)
    schema = "vec_id long, embedding array<double>"
    few = [(i, rng.normal(size=64).tolist()) for i in (100, *range(1, 9))]
    is_query = F.col("vec_id") % 100 == 0
    df = spark.createDataFrame(few, schema)
    plain = _plain_neighbours(few, lambda i: i % 100 == 0, 10)
    assert _neighbours(nearest.search(df, is_query)) == plain and len(plain[100]) == 8

    center = rng.normal(size=64)
    cluster = [(i, (center + rng.normal(scale=1e-3, size=64)).tolist()) for i in range(1, 300) if i % 100]
    rows = [(100, (-center + rng.normal(size=64)).tolist()), (200, center.tolist()), *cluster]
    found = nearest.search(spark.createDataFrame(rows, schema).repartition(5), is_query, part_rows=40)
    assert _neighbours(found) == _plain_neighbours(rows, lambda i: i % 100 == 0, 10)


def test_vectors_of_several_lengths(spark):
    """Every length is searched by itself; a single long vector changes nothing for the others."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(1, 300)]
    odd = [(1000 + i, rng.normal(size=3).tolist()) for i in range(0, 400, 50)] + [(2000, [1.0] * 65)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = _neighbours(nearest.search(df.repartition(3), F.col("vec_id") % 100 == 0))
    assert set(got) == {100, 200, 1000, 1100, 1200, 1300}
    plain = _plain_neighbours(odd[:-1], lambda i: i % 100 == 0, 10)
    assert all(got[q] == plain[q] for q in plain)
    plain = _plain_neighbours(rows, lambda i: i % 100 == 0, 10)
    assert all(len(set(got[q]) & set(plain[q])) >= 9 for q in plain)


def test_neighbours_recall(spark):
    rows = [
        (r.vec_id, [float(x) for x in r.embedding])
        for r in table(spark, "/root/testdata/sf0.1", "embeddings").collect()
    ]
    found = queries.op10_nearest(spark, "/root/testdata/sf0.1").collect()
    plain = _plain_neighbours(rows, lambda i: i % 100 == 0, 10)
    got = {}
    for r in found:
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert set(got) == set(plain) and all(len(v) == 10 for v in got.values())
    hits = sum(len(set(got[q]) & {i for i, _ in v}) for q, v in plain.items())
    assert hits / (10 * len(plain)) >= 0.95
    for q, v in plain.items():
        assert all(abs(got[q][i] - s) < 1e-12 for i, s in v if i in got[q])


def test_hadamard():
    x = np.random.default_rng(0).normal(size=(4, 8))
    assert np.allclose(nearest.hadamard(nearest.hadamard(x)), x)


def test_pipeline_against_plain_versions(spark):
    docs = [
        (r.doc_id, r.text)
        for r in table(spark, SMALL_DIR, "documents").orderBy("doc_id").collect()
        if r.text and any(c.isalpha() for c in r.text)
    ]
    items = [tuple(r) for r in table(spark, SMALL_DIR, "benchmark").select("item_id", "text").collect()]
    linked = brute.groups(docs)
    docs = [(key, text) for key, text in docs if linked[key][1] == key]
    cut = brute.kept_words(docs)
    docs = [(k, cut[k][2] if cut[k][1] else t) for k, t in docs if cut[k][1] < cut[k][0]]
    dirty = brute.contamination(docs, items)
    docs = [(k, t) for k, t in docs if not dirty[k][4]]
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    found = corpus_pipeline.run(spark, SMALL_DIR).collect()
    assert {r.doc_id: list(r.ids) for r in found} == {k: library.encode(t) for k, t in docs}


def test_pipeline_stages_on_edges(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    none = spark.createDataFrame([], schema)
    few = spark.createDataFrame([(1, None, None, None, None), (2, "ab c", None, "s", 4)], schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SMALL_DIR).collect() == []
        found = stage(spark, few, SMALL_DIR)
        assert name == "pieces" or found.columns == columns
        found.collect()


PIPELINE = "doc_id long, text string, lang string, source string, n_chars long"


def _words(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"word{i}" for i in rng.integers(0, 50_000, n))


def _staged(spark, name, rows):
    df = spark.createDataFrame([(*r, "en", "s", None) for r in rows], PIPELINE).repartition(3)
    found = dict(corpus_pipeline.STAGES)[name](spark, df, SMALL_DIR)
    return sorted(((r.doc_id, r.text) for r in found.collect()), key=repr)


def test_near_duplicates_are_told_by_id_and_text(spark):
    """Repeated ids, repeated rows, null ids, and a very long text."""
    base, long = _words(1, 200), _words(2, 60_000)
    near = base.replace(base.split()[100], "other", 1)
    other, third = _words(3, 150), _words(4, 150)
    rows = [(3, base), (5, near), (5, other), (5, other), (6, base.upper()), (7, long), (8, long + " x")]
    rows += [(9, third), (9, third.upper()), (None, base), (None, base), (None, other), (10, "a b")]
    kept = [(3, base), (5, other), (7, long), (10, "a b"), (None, base), (None, other)]
    found = _staged(spark, "near_duplicates", rows)
    nines = [text for key, text in found if key == 9]
    assert len(nines) == 1 and nines[0] in (third, third.upper())
    assert [r for r in found if r[0] != 9] == sorted(kept, key=repr)


def test_decontamination_is_by_id_and_text(spark):
    item = table(spark, SMALL_DIR, "benchmark").where("length(text) > 200").first().text
    clean, long = _words(5, 200), _words(6, 60_000)
    rows = [(1, item), (1, clean), (2, clean), (2, clean), (None, item), (None, clean), (3, long)]
    rows += [(4, f"{long} {item}"), (5, f"{_words(7, 30)} {item}"), (5, f"{_words(7, 30)} {item}")]
    found = _staged(spark, "decontamination", rows)
    wanted = [(1, clean), (2, clean), (2, clean), (3, long), (4, f"{long} {item}"), (None, clean)]
    assert found == sorted(wanted, key=repr)


def test_repeated_passages_of_odd_rows(spark):
    """A null id is in no earlier document; repeated rows lose nothing to each other."""
    passage, own = _words(8, 80), _words(9, 60_000)
    rows = [(1, passage), (2, f"{own} {passage}"), (3, passage), (None, passage), (1, passage)]
    assert _staged(spark, "repeated_passages", rows) == sorted(
        [(1, passage), (1, passage), (2, own), (None, passage)], key=repr
    )


def test_quality_sample_is_bounded_in_rows(spark, monkeypatch):
    """Twenty thousand rows with one id are one row of the sample."""
    many = spark.range(20_000).selectExpr("7L AS doc_id", "concat('text ', id) AS text", "1L AS score")
    some = spark.range(100, 160).selectExpr("id AS doc_id", "concat('other text ', id) AS text", "1L AS score")
    marks = spark.range(100, 130).selectExpr("id AS doc_id", "true AS good", "false AS web").unionByName(
        spark.range(130, 160).selectExpr("id AS doc_id", "false AS good", "true AS web")
    )
    marks = marks.unionByName(spark.sql("SELECT 7L AS doc_id, false AS good, true AS web"))
    seen = []
    monkeypatch.setattr(quality, "train", lambda p, u, prior, **_: seen.append((len(p), len(u))))
    monkeypatch.setattr(quality, "estimate_prior", lambda p, u: 0.5)
    quality.fit(many.unionByName(some), marks, "good", "web", sample=25)
    assert seen == [(25, 25)]
    quality.fit(many.unionByName(some), marks, "good", "web", sample=100)
    assert seen[1] == (30, 31)


def test_pieces_query_covers_the_spans_of_all_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    wanted = {}
    for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect():
        text = r.text or ""
        pieces = library.encode(text, return_type="proto").pieces
        begins = ",".join(str(p.begin) for p in pieces)
        ends = ",".join(str(p.end) for p in pieces)
        wanted[r.doc_id] = len(pieces), brute.sha(f"{begins};{ends}")
    found = queries.op9_sentence_pieces(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_tokens, r.spans_sha256) for r in found} == wanted
