"""Mixing sources to target weights by min-cost flow.

A document may belong to several sources. Documents are aggregated by membership pattern
(the sorted set of their sources); a small network routes each pattern's words to its
sources' quotas, where the first copy of a pattern is free and every further copy costs
more (convex), so repetition is used only where quotas need it and spreads evenly. A
pattern's flow then becomes copies of documents: everyone gets the whole copies, and
documents drawn in the order of a seeded digest get one more until the rest is used up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabline.llm import common as C
from cabline.operators.ranking import rank_within
from cabline.session import materialize_at


@dataclass(frozen=True)
class MixParams:
    """weights: relative weights of the sources in code point order (null last), repeating.
    copies: most copies of a document. seed: of the draw. max_patterns: distinct membership
    patterns the driver may hold (an error beyond: the mix needs coarser sources)."""

    weights: tuple[int, ...] = (5, 2, 1)
    copies: int = 3
    seed: str = "mix-1"
    max_patterns: int = 100_000


def fill_targets(sizes: list[int], weights: list[int], total: int, copies: int) -> list[float]:
    """Shares of ``total`` by weight; a target stops at copies * size and what exceeds it
    is shared anew among the others until none is above."""
    capped: set[int] = set()
    while True:
        rest = total - sum(copies * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        level = rest / weight if weight else 0.0
        over = {i for i, w in enumerate(weights) if i not in capped and w * level > copies * sizes[i]}
        if not over:
            return [float(copies * s) if i in capped else w * level for i, (s, w) in enumerate(zip(sizes, weights))]
        capped |= over


def route(patterns: list[tuple[int, list[int]]], quotas: list[int], copies: int) -> list[dict[int, int]]:
    """Words of each pattern (size, sources) that go to each source: a flow that meets the
    quotas as far as possible at the least cost, the k-th copy costing k - 1 a word.

    Successive cheapest augmenting paths. Costs are whole numbers below ``copies`` and a
    path's cost never falls, so patterns are opened copy by copy, and rerouting through
    sources is a breadth-first search in the residual network.
    """
    flow: list[dict[int, int]] = [dict.fromkeys(s, 0) for _, s in patterns]
    users: dict[int, list[int]] = {}
    for p, (_, sources) in enumerate(patterns):
        for s in sources:
            users.setdefault(s, []).append(p)
    left = list(quotas)
    for _ in range(copies):
        room = [size for size, _ in patterns]
        for start in range(len(patterns)):
            while room[start]:
                came: dict[int, tuple[int, int | None]] = {}      # source -> (pattern, source before)
                queue: list[int] = []
                for s in patterns[start][1]:
                    came[s] = (start, None)
                    queue.append(s)
                goal = next((s for s in queue if left[s]), None)
                for s in queue:
                    if goal is not None:
                        break
                    for q in users[s]:
                        if flow[q][s]:
                            for t in patterns[q][1]:
                                if t not in came:
                                    came[t] = (q, s)
                                    queue.append(t)
                                    if left[t] and goal is None:
                                        goal = t
                if goal is None:
                    break
                steps, s = [], goal
                while s is not None:
                    p, prev = came[s]
                    steps.append((p, s, prev))
                    s = prev
                amount = min([room[start], left[goal], *(flow[p][prev] for p, _, prev in steps if prev is not None)])
                for p, s, prev in steps:
                    flow[p][s] += amount
                    if prev is not None:
                        flow[p][prev] -= amount
                left[goal] -= amount
                room[start] -= amount
    return flow


def mix(docs: DataFrame, sources: Column, size: Column, key: Column, params: MixParams | None = None) -> DataFrame:
    """Every row of ``docs`` (struct ``row``) with ``size``, ``source_size`` and ``target``
    (of its first source), ``copies`` (0 to params.copies) and ``taken`` (size * copies).

    sources: array column of a document's sources (a null element is a source of its own; a
    null or empty array counts as the null source). key: what the draw hashes. Rows of size
    0 take nothing. Repeated rows draw the same ticket and are served in turn, so the set
    of results is the same in every run. A text's length is but a number here. The input's
    columns are inside ``row``, so none can clash. An empty table gives an empty result.
    """
    p = params or MixParams()
    spark = docs.sparkSession
    sources = F.when(F.coalesce(F.size(sources), F.lit(0)) > 0, F.array_sort(F.array_distinct(sources))).otherwise(
        F.array(F.lit(None).cast("string")))
    ticket = F.md5(F.concat(F.lit(f"{p.seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), size.cast("long").alias("size"),
        F.to_json(sources).alias("pattern"), sources.alias("sources"), ticket.alias("ticket"))
    rows = rows.withColumn("bin", F.conv(F.substring("ticket", 1, 4), 16, 10).cast("int"))

    bins, _ = materialize_at(rows.groupBy("pattern", "bin").agg(F.first("sources").alias("sources"), F.sum("size").alias("words")), "mix-bins")
    patterns = bins.groupBy("pattern").agg(F.first("sources").alias("sources"), F.sum("words").alias("words")).orderBy("pattern").limit(p.max_patterns + 1).collect()
    if len(patterns) > p.max_patterns:
        raise ValueError(f"over {p.max_patterns} membership patterns; group the sources first")
    names = sorted({s for r in patterns for s in r["sources"]}, key=lambda s: (s is None, s or ""))
    number = {s: i for i, s in enumerate(names)}
    sizes = [0] * len(names)
    for r in patterns:
        for s in r["sources"]:
            sizes[number[s]] += r["words"]
    weights = [p.weights[i % len(p.weights)] for i in range(len(names))]
    targets = fill_targets(sizes, weights, sum(r["words"] for r in patterns), p.copies) if names else []
    flow = route([(r["words"], [number[s] for s in r["sources"]]) for r in patterns], [int(t) for t in targets], p.copies)
    plan = []
    for r, f in zip(patterns, flow):
        full, rest = divmod(sum(f.values()), r["words"]) if r["words"] else (0, 0)
        home = number[r["sources"][0]]
        plan.append((r["pattern"], int(full), int(rest), sizes[home], float(targets[home])))
    plan = spark.createDataFrame(plan, "pattern string, full long, rest long, source_size long, target double")

    # the bin in which a pattern's rest runs out, and what is left of the rest there
    upto = Window.partitionBy("pattern").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = (
        bins.join(F.broadcast(plan), "pattern").withColumn("sum", F.sum("words").over(upto))
        .where("sum >= rest and sum - words < rest")
        .select("pattern", F.col("bin").alias("edge"), (F.col("rest") - F.col("sum") + F.col("words")).alias("in_edge")))
    plan = F.broadcast(plan.join(edge, "pattern", "left"))   # at most max_patterns rows
    rows = rows.join(plan, "pattern")
    inside = F.col("bin") == F.col("edge")
    out = ["row", "size", "source_size", "target", "copies"]
    sure = rows.where(F.coalesce(~inside, F.lit(True))).withColumn(
        "copies", F.col("full") + F.coalesce((F.col("bin") < F.col("edge")).cast("long"), F.lit(0)))
    near, _ = materialize_at(rows.where(inside), "mix-edge")
    # rows of one ticket and size are alike: they are counted, however many they are, and
    # get one more copy as long as it brings the total nearer to the rest
    alike = near.groupBy("pattern", "ticket", "size").agg(F.count("*").alias("n"), F.first("in_edge").alias("in_edge"))
    order = Window.partitionBy("pattern").orderBy("ticket", "size").rowsBetween(Window.unboundedPreceding, -1)
    alike = alike.withColumn("before", F.coalesce(F.sum(F.col("size") * F.col("n")).over(order), F.lit(0)))
    fit = F.when(F.col("size") > 0, F.expr("(2 * in_edge + size - 2 * before) div (2 * size)")).otherwise(
        F.when(F.col("before") <= F.col("in_edge"), F.col("n")).otherwise(0))
    alike = alike.select("pattern", "ticket", "size", "n", F.greatest(F.lit(0), F.least("n", fit)).alias("more"))
    near = near.join(alike, ["pattern", "ticket", "size"])
    some = (F.col("more") > 0) & (F.col("more") < F.col("n"))          # one group a pattern at most
    whole = near.where(~some).withColumn("copies", F.col("full") + (F.col("more") > 0).cast("long"))
    part = rank_within(near.where(some).select("pattern", "more", "full", *out[:-1]), ["pattern"], [F.asc("size")])
    part = part.withColumn("copies", F.col("full") + (F.col("_rn") <= F.col("more")).cast("long"))
    near = whole.select(*out).unionByName(part.select(*out))
    both = sure.select(*out).unionByName(near.select(*out))
    return both.withColumn("taken", F.col("size") * F.col("copies"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(C.WORD)), F.lit(0)).cast("long")


def mix_documents(docs: DataFrame, params: MixParams | None = None) -> DataFrame:
    """``mix`` over the columns doc_id, text and source of ``docs``; size: words of the text."""
    return mix(docs, F.array("source"), word_count(docs["text"]), docs["doc_id"], params)


def take_mix(docs: DataFrame, params: MixParams | None = None) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it was drawn."""
    out = mix_documents(docs, params).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select(*C.unkeyed(out, docs.columns))
