"""Mixing sources: targets, flows and chosen documents against plain versions."""

import random
from collections import Counter, defaultdict
from fractions import Fraction

import brute
import pytest
from pyspark.sql import functions as F

from feedloom.llm import queries, source_mix


def plain_targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = {s: Fraction(sum(sizes.values()) * weight[s], sum(weight.values())) for s in names}
    while True:
        above = {s for s in names if target[s] > most * sizes[s]}
        if not above:
            return {s: float(t) for s, t in target.items()}
        excess = sum(target[s] - most * sizes[s] for s in above)
        target |= {s: Fraction(most * sizes[s]) for s in above}
        below = [s for s in names if target[s] < most * sizes[s]]
        if not below:
            return {s: float(t) for s, t in target.items()}
        for s in below:
            target[s] += excess * weight[s] / sum(weight[b] for b in below)


def plain_cost(patterns, quotas, most):
    """The least cost of the largest flow, by single words along cheapest ways (Bellman-Ford)."""
    n, names = len(patterns), sorted(quotas)
    arcs = []  # [from, to, room, cost]

    def arc(a, b, room, cost):
        arcs.extend(([a, b, room, cost], [b, a, 0, -cost]))

    for p, (size, own) in enumerate(patterns):
        for level in range(most):
            arc("in", p, size, (level + 1) ** 2)
        for s in own:
            arc(p, n + names.index(s), 10**9, 0)
    for s in names:
        arc(n + names.index(s), "out", quotas[s], 0)
    total = moved = 0
    while True:
        far, via = {"in": 0}, {}
        for _ in range(len(patterns) + len(names) + 2):
            for i, (a, b, room, cost) in enumerate(arcs):
                if room and a in far and far[a] + cost < far.get(b, 10**9):
                    far[b], via[b] = far[a] + cost, i
        if "out" not in far:
            return total, moved
        node = "out"
        while node != "in":
            i = via[node]
            arcs[i][2] -= 1
            arcs[i ^ 1][2] += 1
            node = arcs[i][0]
        total, moved = total + far["out"], moved + 1


@pytest.mark.parametrize("seed", range(25))
def test_flow_costs_least(seed):
    draw = random.Random(seed)
    sources = range(draw.randint(1, 5))
    patterns = [
        (draw.randint(1, 12), sorted(draw.sample(sources, draw.randint(1, len(sources)))))
        for _ in range(draw.randint(1, 7))
    ]
    quotas = {s: draw.randint(0, 25) for s in sources}
    sent = source_mix.flow(patterns, quotas, 3)
    cost = 0
    for (size, own), to in zip(patterns, sent):
        given = sum(to.values())
        assert set(to) == set(own) and min(to.values()) >= 0 and given <= 3 * size
        cost += sum(min(max(0, given - level * size), size) * (level + 1) ** 2 for level in range(3))
    got = Counter()
    for to in sent:
        got.update(to)
    assert all(got[s] <= quotas[s] for s in sources)
    assert (cost, sum(got.values())) == plain_cost(patterns, quotas, 3)


@pytest.mark.parametrize("seed", range(20))
def test_share_out_comes_near(seed):
    draw = random.Random(seed)
    counts = Counter(min(20_000, int(draw.paretovariate(0.6))) for _ in range(draw.randint(3, 400)))
    sizes = [(s, n, draw.random()) for s, n in sorted(counts.items(), reverse=True)]
    whole, reachable = sum(s * n for s, n, _ in sizes), 1
    for s, n, _ in sizes:
        for _ in range(n):
            reachable |= reachable << s
    for rest in {0, 1, whole // 3, whole // 2, whole - 1}:
        taken = source_mix.share_out(sizes, rest)
        assert all(0 <= m <= n for m, (_, n, _) in zip(taken, sizes))
        got = sum(m * s for m, (s, _, _) in zip(taken, sizes))
        best = min(abs(rest - x) for x in range(whole + 1) if reachable >> x & 1)
        assert abs(rest - got) <= best + sizes[-1][0]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    found = queries.QUERIES["op11_source_mix"](spark, sf_dir)
    assert [c for c, _ in found.dtypes] == ["doc_id", "size", "source_size", "target", "taken"]
    rows = {r.doc_id: r for r in found.collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(docs)
    sizes, taken = defaultdict(int), defaultdict(int)
    for d in docs:
        assert rows[d.doc_id].size == len(brute.SPACED.findall(d.text or ""))
        sizes[d.source] += rows[d.doc_id].size
        taken[d.source] += rows[d.doc_id].taken
        assert rows[d.doc_id].taken in [rows[d.doc_id].size * i for i in range(4)]
    target = plain_targets(sizes)
    for d in docs:
        assert rows[d.doc_id].source_size == sizes[d.source]
        assert rows[d.doc_id].target == pytest.approx(target[d.source])
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    for s in sizes:
        assert taken[s] == pytest.approx(target[s], rel=0.01, abs=50)
    assert _rows(queries.QUERIES["op11_source_mix"](spark, sf_dir)) == _rows(found)


def test_overlapping_sources(spark):
    draw = random.Random(4)
    choices = [["a"], ["a", "b"], ["b", "a", "a"], ["c"], ["c", None], [None], ["d", "b"], [], None]
    docs = [(i, " ".join(["w"] * draw.randint(0, 60)), draw.choice(choices), "?") for i in range(1500)]
    df = spark.createDataFrame(docs, "doc_id long, text string, tags array<string>, size string")
    found = source_mix.mix(df.repartition(5), F.col("tags"), weights=(5, 1, 1, 2))
    rows = {r.doc_id: r for r in found.rows.collect()}
    assert len(rows) == len(docs)
    order = lambda s: (s is None, s or "")
    words = Counter()
    for i, text, tags, _ in docs:
        assert rows[i].sources == sorted(set(tags or []), key=order)
        words[tuple(rows[i].sources)] += len(text.split())
    sizes = Counter()
    for pattern, n in words.items():
        sizes.update(dict.fromkeys(pattern, n))
    target = plain_targets(dict(sizes), (5, 1, 1, 2))
    sources = {r.source: r for r in found.sources.collect()}
    assert {s: r.target for s, r in sources.items()} == pytest.approx(target)

    routed, names = defaultdict(Counter), {r.place: s for s, r in sources.items()}
    for r in found.routes.collect():
        assert names[r.place] in r.sources
        routed[tuple(r.sources)][names[r.place]] = r.words
    for s, r in sources.items():
        assert sum(own[s] for own in routed.values()) <= r.quota
    patterns = [(n, [names_ for names_ in p]) for p, n in words.items() if p and n]
    place = {s: r.place for s, r in sources.items()}
    least = plain_cost([(n // 50, [place[s] for s in p]) for n, p in patterns],
                       {r.place: r.quota // 50 for r in sources.values()}, 3)
    assert sum(sum(own.values()) for own in routed.values()) == pytest.approx(50 * least[1], rel=0.02)
    taken = Counter()
    for r in rows.values():
        assert r.taken == r.size * r.repeats and 0 <= r.repeats <= 3
        taken[tuple(r.sources)] += r.taken
    assert taken[()] == 0
    for pattern in routed:
        assert abs(taken[pattern] - sum(routed[pattern].values())) <= 60


EDGE = "doc_id long, text string, source string, place string, size string, twin string, weight string"


def _mix(spark, docs, **options):
    df = spark.createDataFrame([(*d, *"????") for d in docs], EDGE)
    return source_mix.mix(df.repartition(4), F.array("source"), **options)


def test_edges(spark):
    docs = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", "b"), (None, "x y z", None), (None, "p q", None)]
    docs += [(4, "one\x0btwo\x0cthree four", "a"), (5, "word " * 300_000, "c"), (6, "é ü", "B")]
    docs += [(7, "same text here", "a")] * 50 + [(7, "same key only", "b")]
    found = _mix(spark, docs)
    rows = found.rows.collect()
    assert len(rows) == len(docs)
    assert Counter((r.doc_id, r.sources[0], r.size) for r in rows) == Counter(
        (key, source, len(brute.SPACED.findall(text or ""))) for key, text, source in docs
    )
    sizes = Counter()
    for r in rows:
        sizes[r.sources[0]] += r.size
    target = plain_targets(dict(sizes))
    assert {r.source: r.target for r in found.sources.collect()} == pytest.approx(target)
    assert _rows(_mix(spark, docs).rows) == _rows(found.rows)
    # Of fifty equal rows some are taken once more: which of them does not matter, how many does.
    fifty = Counter(r.taken for r in rows if r.doc_id == 7 and r.sources == ["a"])
    assert sum(fifty.values()) == 50 and len(fifty) <= 2
    assert sum(r.taken for r in rows if r.sources == ["a"]) == pytest.approx(target["a"], abs=2)


def test_seed_changes_the_choice_only(spark):
    draw = random.Random(1)
    docs = [(i, "w " * draw.randint(1, 30), "ab"[i % 2]) for i in range(400)]
    one, other = (
        {r.doc_id: r.taken for r in _mix(spark, docs, seed=s).rows.collect()} for s in (1, 2)
    )
    assert one != other
    assert abs(sum(one.values()) - sum(other.values())) <= 4


def test_no_rows_and_no_words(spark):
    found = _mix(spark, [])
    assert found.rows.collect() == [] and found.sources.collect() == []
    found = _mix(spark, [(1, "", "a"), (2, None, None)])
    assert {(r.doc_id, r.size, r.taken) for r in found.rows.collect()} == {(1, 0, 0), (2, 0, 0)}
    assert {(r.source, r.target) for r in found.sources.collect()} == {("a", 0.0), (None, 0.0)}


def test_ranks_of_a_hot_group(spark):
    rows = spark.range(30_000).selectExpr("id % 2 * (id % 3) AS g", "id * 7919 % 30000 AS x", "id")
    found = source_mix.ranked(rows.repartition(9), ["g"], ["x", "id"]).collect()
    by_group = defaultdict(list)
    for r in found:
        by_group[r.g].append((r.x, r.place))
    for own in by_group.values():
        assert [place for _, place in sorted(own)] == list(range(len(own)))
