"""Fill-in-the-middle outputs against a plain version, and back."""

import re

import brute
import pytest
from pyspark.sql import functions as F

from feedloom.llm import fill_in_middle


def expected(key, text, seed=7, rate=100, spm_rate=50):
    """(n, form, prefix_chars, middle_chars, output)"""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = brute.sha(f"{seed}:{'' if key is None else key}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def _texts():
    long = "".join(f"line {i} äöü €\n" for i in range(30_000))
    return [
        (1, None), (2, ""), (3, "one"), (4, "\n"), (5, "\n\n\n"), (6, "a\nb\nc\n"), (7, "a\nb\nc"),
        (8, "x <P> y\nz"), (9, "<M>"), (10, "a <S"), (11, "<\n<P\n<S\nP>\n>"), (12, "é\r\n ü\x85\n𝄞"),
        (13, long), (14, "no line feed " * 40_000), (15, long + "<M>"), (None, "null\nkey\n"),
        (None, "other\nnull\nkey"), (16, "repeated\nrow\n"), (16, "repeated\nrow\n"),
        (16, "same key\nother text"), (-17, "x\ny\nz\n"), *((k, f"{k}\n" * (k % 7)) for k in range(20, 90)),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    names = "doc task position piece n form copies place fingerprint h1 marked"
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names.split())
    rows = [(*row, *["?"] * len(names.split())) for row in _texts()]
    return spark.createDataFrame(rows, schema).repartition(4)


@pytest.mark.parametrize("piece_bytes", [fill_in_middle.PIECE_BYTES, 7])
def test_digests(spark, docs, piece_bytes):
    rows = docs if piece_bytes > 100 else docs.where(F.length("text") < 1000)
    found = fill_in_middle.digests(fill_in_middle.pieces(rows, piece_bytes=piece_bytes))
    told = sorted((tuple(r) for r in found.collect()), key=repr)
    wanted = []
    for key, text in ((r.doc_id, r.text) for r in rows.collect()):
        n, form, p, m, output = expected(key, text)
        wanted.append((key, n, form, p, m, brute.sha(output), brute.sha(text or "")))
    assert told == sorted(wanted, key=repr)


@pytest.mark.parametrize("rates", [(100, 50), (60, 100), (0, 0)])
def test_outputs_and_back(spark, docs, rates):
    options = {"seed": 11, "rate": rates[0], "spm_rate": rates[1]}
    found = fill_in_middle.texts(fill_in_middle.pieces(docs, **options)).collect()
    wanted = [(key, *expected(key, text, 11, *rates)) for key, text in _texts()]
    assert sorted(((r.doc_id, r.form, r.output) for r in found), key=repr) == sorted(
        ((w[0], w[2], w[5]) for w in wanted), key=repr
    )
    back = sorted(fill_in_middle.restore(r.output, r.form) for r in found)
    assert back == sorted(text or "" for _, text in _texts())


def test_pieces_are_bounded_runs_of_units(spark, docs):
    found = fill_in_middle.pieces(docs)
    limit = fill_in_middle.PIECE_BYTES + fill_in_middle.MARK_BYTES
    assert found.agg(F.max(F.length("piece"))).first()[0] <= limit
    long = found.where("doc = 13 AND position > 0").orderBy("position").collect()
    assert len(long) > 5
    assert all(bytes(r.piece).endswith(b"\n") or len(r.piece) == 3 for r in long)


def test_copies_meet_in_no_task(spark):
    """Equal rows are one document in each of the tasks that read them, not one in all."""
    rows = spark.range(40_000).selectExpr("1L AS doc_id", "'a\nb\nc\n' AS text").repartition(8)
    found = fill_in_middle.pieces(rows)
    heads = found.where("position = 0").groupBy("task").agg(F.sum("copies").alias("copies")).collect()
    assert len(heads) == 8 and sum(r.copies for r in heads) == 40_000
    told = fill_in_middle.digests(found)
    assert told.count() == 40_000 and told.distinct().count() == 1


def test_one_shuffle(spark, docs):
    plan = fill_in_middle.digests(fill_in_middle.pieces(docs.coalesce(2)))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("RepartitionByExpression") == 1
    assert text.count("Sort [") == 2


def test_no_rows(spark, empty):
    found = fill_in_middle.pieces(empty)
    assert fill_in_middle.digests(found).collect() == []
    assert fill_in_middle.texts(found).collect() == []
