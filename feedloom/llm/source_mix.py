"""A mix of documents from overlapping sources, with a share for each source.

Every source has a weight; the sources share the words of the whole table by weight, none above ``most``
times its own words, and what is above is shared again among the others.

1. Documents are counted by membership pattern, the set of sources they belong to.
2. Words flow from patterns to the quotas of their sources. A pattern can give its words ``most`` times
   over, and every repetition costs more than the one before. Only the repetitions have costs, so the
   cheapest way to more words always starts at the lowest repetition that is open: the minimum-cost flow
   is a maximum flow with one repetition, increased by what a second one adds, and so on. Sources that
   share no pattern, not even through others, do not concern each other; each connected set of them is
   solved apart, in a task of its own over one row for each pattern.
3. A pattern's flow is so many whole repetitions of all its documents and a rest. The rest is dealt over
   its documents' sizes in proportion, from the largest down, so that what one size leaves over falls to
   smaller ones; which way a fraction is rounded depends on the seed. Of equally large documents the ones
   that hash lowest under the seed are taken once more. Places by hash come from a range-partitioned sort
   and counts of its parts, so that no number of equal documents meets in one task.

Texts are read once; then one narrow row for each document lies in the shared folder. What the driver
gets are single numbers.

- Null and empty texts have no words and are taken with none.
- A null source is a source like any other and comes last. A row without sources is not taken.
- Rows with equal key and text are told apart by their place in the stored table; which of them are taken
  more often makes no difference to the rows of the result.
- A document is taken as a whole, so a source comes as near to its target as its documents' sizes allow.
- Long texts are read whole. Further columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from feedloom.llm.arrays import chunks, words
from feedloom.llm.components import components
from feedloom.llm.tables import stored

WEIGHTS = (1, 2, 3)  # of the sources in order, over and over
MOST = 3
SEED = 7

_PATTERN = StructField("sources", ArrayType(StringType()))


class Mix(NamedTuple):
    """``rows``: key, ``sources``, ``size``, ``repeats``, ``taken``. ``sources``: ``source``, ``place``,
    ``weight``, ``size``, ``target``, ``quota``. ``routes``: the words each pattern gives each source."""

    rows: DataFrame
    sources: DataFrame
    routes: DataFrame


def ranked(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Rows with ``place``, their number from 0 in their group by the order columns, nulls last.

    The order has to break all ties. Rows are dealt by ranges of group and order, so a group of any size
    is spread; a row's place is its place in its part and the count of its group in the parts before.
    """
    by = [*group, *(F.asc_nulls_last(c) for c in order)]
    dealt = rows.repartitionByRange(*by).withColumn("_part", F.spark_partition_id())
    dealt = stored(dealt, "ranked")
    counts = dealt.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = counts.select(
        *group, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    own = Window.partitionBy(*group, "_part").orderBy(*by[len(group) :])
    return (
        dealt.withColumn("_own", F.row_number().over(own) - 1)
        .join(before, [*group, "_part"])
        .withColumn("place", F.col("_own") + F.col("_before"))
        .drop("_own", "_before", "_part")
    )


def _sized(schema: StructType):
    """Rows (text, ...) into (..., size), the number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.zeros(batch.num_rows, np.int64)
            for chunk in chunks(batch.column(0)):
                sizes[chunk.first : chunk.last] = np.diff(words(chunk).bounds)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sizes)], schema.names)

    return run


def sized(df: DataFrame, sources: Column, key: str, text: str, seed: int) -> DataFrame:
    """``key``, ``sources`` (a sorted set), ``mark`` (the seeded hash), ``size`` and ``twin``, stored."""
    members = F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>"))))
    read = df.select(
        F.col(text).alias("text"), F.col(key).alias("key"),
        members.cast("array<string>").alias("sources"),
        F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("mark"),
    )
    schema = StructType(
        [StructField("key", df.schema[key].dataType), _PATTERN,
         StructField("mark", LongType()), StructField("size", LongType())]
    )
    rows = read.mapInArrow(_sized(schema), schema)
    return stored(rows.withColumn("twin", F.monotonically_increasing_id()), "mix-rows")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, size)`` with ``place``, ``weight``, ``target`` and ``quota``, the target in whole words.

    All words are shared out by weight. A source whose share is above ``most`` times its size gets just
    that, the others share the rest, and so on; each turn is one aggregate over the sources.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    placed = ranked(sizes, [], ["source"])
    table = stored(
        placed.withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int"))),
        "mix-sources",
    )
    whole, weight = table.agg(F.sum("size"), F.sum("weight")).first()
    share, known = (whole / weight if weight else 0.0), -1
    full = F.col("size") * most
    while weight:
        above = full <= F.col("weight") * F.lit(share)
        count, words_, open_ = table.agg(
            F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(above, full)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
        ).first()
        if count == known or not open_:
            break
        known, share = count, (whole - words_) / open_
    target = F.least(full.cast("double"), F.col("weight") * F.lit(float(share)))
    return table.withColumn("target", target).withColumn("quota", F.round("target").cast("bigint"))


def flow(patterns: list[tuple[int, list[int]]], quotas: dict[int, int], most: int) -> list[dict[int, int]]:
    """For each pattern ``(words, sources)`` the words that go to each of its sources.

    A minimum-cost flow, one repetition after another: shortest augmenting paths in layers, with the
    words that already flow to a source as ways back.
    """
    sent: list[dict[int, int]] = [dict.fromkeys(own, 0) for _, own in patterns]
    givers: dict[int, list[int]] = {}
    for p, (_, own) in enumerate(patterns):
        for s in own:
            givers.setdefault(s, []).append(p)
    left, spare = dict(quotas), [0] * len(patterns)
    for _ in range(most):
        spare = [have + size for have, (size, _) in zip(spare, patterns)]
        while _augment(patterns, givers, sent, left, spare):
            pass
    return sent


def _augment(patterns, givers, sent, left, spare) -> bool:
    """Send all that goes along the shortest ways from patterns with spare words to unfilled sources."""
    depth = {("p", p): 0 for p, have in enumerate(spare) if have}
    queue, found = deque(depth), None
    while queue:
        node = queue.popleft()
        kind, i = node
        if found is not None and depth[node] >= found:
            break
        if kind == "s" and left[i]:
            found = depth[node]
            continue
        steps = (
            [("s", s) for s in patterns[i][1]] if kind == "p"
            else [("p", p) for p in givers[i] if sent[p][i]]
        )
        for step in steps:
            if step not in depth:
                depth[step] = depth[node] + 1
                queue.append(step)
    if found is None:
        return False
    tried: dict[tuple, int] = {}

    def steps_of(node):
        kind, i = node
        return [("s", s) for s in patterns[i][1]] if kind == "p" else [("p", p) for p in givers[i]]

    def open_(a, b) -> int | None:
        """Words that fit from node to node; None: any number."""
        return None if a[0] == "p" else sent[b[1]][a[1]]

    moved = False
    for start in [p for p, have in enumerate(spare) if have]:
        path = [("p", start)]
        while path and spare[start]:
            node = path[-1]
            if node[0] == "s" and left[node[1]]:
                limits = [spare[start], left[node[1]]]
                limits += [o for o in map(open_, path, path[1:]) if o is not None]
                amount = min(limits)
                for a, b in zip(path, path[1:]):
                    if a[0] == "p":
                        sent[a[1]][b[1]] += amount
                    else:
                        sent[b[1]][a[1]] -= amount
                spare[start] -= amount
                left[node[1]] -= amount
                moved = True
                path = [("p", start)]
                continue
            options = steps_of(node)
            at = tried.get(node, 0)
            while at < len(options):
                step = options[at]
                if depth.get(step) == depth[node] + 1 and open_(node, step) != 0:
                    break
                at += 1
            tried[node] = at
            if at < len(options):
                path.append(options[at])
            else:
                path.pop()
                if path:
                    tried[path[-1]] += 1
    return moved


_ROUTES = StructType(
    [_PATTERN, StructField("place", LongType()), StructField("words", LongType())]
)


def _solve(most: int):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["places"])
        quotas = {p: q for r in rows for p, q in zip(r["places"], r["quotas"])}
        sent = flow([(r["words"], r["places"]) for r in rows], quotas, most)
        out = [(r["sources"], p, n) for r, own in zip(rows, sent) for p, n in own.items()]
        columns = list(zip(*out)) or [(), (), ()]
        kinds = (pa.list_(pa.string()), pa.int64(), pa.int64())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=_ROUTES.names)

    return run


def routes(patterns: DataFrame, sources: DataFrame, most: int = MOST) -> DataFrame:
    """``(sources, place, words)``: the words that a pattern gives a source, by the source's place.

    ``patterns`` holds ``sources`` and ``words``; those without words are left out.
    """
    members = patterns.where("words > 0").select("sources", "words", F.explode("sources").alias("_source"))
    quotas = sources.select(F.col("source").alias("_named"), "place", "quota")
    named = members.join(quotas, F.col("_source").eqNullSafe(F.col("_named"))).select(
        "sources", "words", "place", "quota"
    )
    whole = named.groupBy("sources", "words").agg(
        F.array_sort(F.collect_list(F.struct("place", "quota"))).alias("_ends")
    )
    whole = stored(
        whole.select("sources", "words", F.col("_ends.place").alias("places"),
                     F.col("_ends.quota").alias("quotas"), F.col("_ends.place")[0].alias("node")),
        "mix-patterns",
    )
    links = whole.where(F.size("places") > 1).select(
        F.col("node").alias("a"), F.explode("places").alias("b")
    )
    component = F.col("node")
    if not links.isEmpty():
        sets = components(links)
        whole = whole.join(sets, "node", "left")
        component = F.coalesce("component", "node")
    return whole.select(component.alias("set"), "sources", "words", "places", "quotas").groupBy(
        "set"
    ).applyInArrow(_solve(most), _ROUTES)


def share_out(sizes: list[tuple[int, int, float]], rest: int) -> list[int]:
    """How many of the ``n`` documents of each size are taken so that their words come near ``rest``.

    ``sizes`` holds (size, n, chance), the largest first; no size is 0.
    """
    open_, out = sum(size * n for size, n, _ in sizes), []
    for size, n, chance in sizes:
        after = open_ - size * n
        wish = max(0.0, min(float(n), rest * n / open_))
        low = min(n - 1, int(wish))

        def off(m: int) -> tuple[int, float]:
            """How far the sizes that follow are from making good what is left, then the draw."""
            left = rest - m * size
            return max(0, -left, left - after), abs(m - low - (chance < wish - low))

        out.append(min((low, low + 1), key=off))
        rest -= out[-1] * size
        open_ = after
    return out


_PLAN = StructType(
    [_PATTERN] + [StructField(c, LongType()) for c in ("size", "n", "whole", "more")]
)


def _plan(table: pa.Table) -> pa.Table:
    """One pattern's sizes: ``whole`` repetitions of all documents, and one more of ``more`` of them."""
    table = table.sort_by([("size", "descending")])
    size, n, hashed = (table.column(c).to_numpy() for c in ("size", "n", "chance"))
    words_ = table.column("words")[0].as_py()
    whole, rest = divmod(words_, int((size * n).sum()))
    chance = (hashed.astype(np.uint64) >> np.uint64(11)) / float(1 << 53)
    more = share_out(list(zip(size.tolist(), n.tolist(), chance.tolist())), rest)
    columns = [table.column("sources"), table.column("size"), table.column("n")]
    columns += [pa.array(np.full(len(more), whole)), pa.array(more, pa.int64())]
    return pa.table(columns, names=_PLAN.names)


def mix(
    df: DataFrame, sources: Column, key: str = "doc_id", text: str = "text", *,
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED,
) -> Mix:
    """Choose how often each document is taken. ``sources`` is an array of the row's sources."""
    rows = sized(df, sources, key, text, seed)
    patterns = stored(rows.groupBy("sources").agg(F.sum("size").alias("words")), "mix-counts")
    own = patterns.select(F.explode("sources").alias("source"), "words")
    table = stored(
        targets(own.groupBy("source").agg(F.sum("words").alias("size")), weights, most), "mix-targets"
    )
    routed = stored(routes(patterns, table, most), "mix-routes")

    flows = routed.groupBy("sources").agg(F.sum("words").alias("words"))
    sizes = rows.where("size > 0").groupBy("sources", "size").agg(F.count("*").alias("n"))
    # A pattern's sizes meet in one task: a row for each different size, whatever the number of documents.
    chance = F.xxhash64(F.lit(seed), "sources", "size").alias("chance")
    plan = stored(
        sizes.join(flows, "sources").select("*", chance).groupBy("sources").applyInArrow(_plan, _PLAN),
        "mix-plan",
    )
    planned = rows.join(plan, ["sources", "size"], "left")
    part = (F.col("more") > 0) & (F.col("more") < F.col("n"))
    settled = planned.where(~F.coalesce(part, F.lit(False))).withColumn(
        "repeats", F.coalesce(F.col("whole") + (F.col("more") > 0).cast("long"), F.lit(0))
    )
    chosen = ranked(planned.where(part), ["sources", "size"], ["mark", "key", "twin"]).withColumn(
        "repeats", F.col("whole") + (F.col("place") < F.col("more")).cast("long")
    )
    columns = [F.col("key").alias(key), "sources", "size", F.col("repeats").cast("int"),
               (F.col("size") * F.col("repeats")).alias("taken")]
    found = settled.select(*columns).unionByName(chosen.select(*columns))
    return Mix(found, table, routed)
