import hashlib
import itertools
import random

from pyspark.sql import functions as F

from cabline.llm import mixing as M


def test_targets_by_hand():
    assert M.fill_targets([10, 10, 10], [5, 2, 1], 30, 3) == [18.75, 7.5, 3.75]
    assert M.fill_targets([1, 100, 100], [5, 2, 1], 201, 3) == [3.0, 132.0, 66.0]
    got = M.fill_targets([1, 2, 1000], [5, 2, 1], 1003, 3)
    assert got[:2] == [3.0, 6.0] and got[2] == 994.0
    assert M.fill_targets([0], [5], 0, 3) == [0.0]


def cost(patterns, flow, copies):
    total = 0
    for (size, _), f in zip(patterns, flow):
        words = sum(f.values())
        for k in range(copies):
            total += k * max(0, min(size, words - k * size))
    return total


def test_flow_is_largest_and_cheapest():
    """Against all whole flows of small networks."""
    rng = random.Random(2)
    for _ in range(60):
        patterns = [(rng.randint(1, 2), sorted(rng.sample(range(3), rng.randint(1, 3)))) for _ in range(rng.randint(1, 3))]
        quotas = [rng.randint(0, 4) for _ in range(3)]
        flow = M.route(patterns, quotas, 2)
        into = [sum(f.get(s, 0) for f in flow) for s in range(3)]
        assert all(x <= q for x, q in zip(into, quotas))
        assert all(0 <= v for f in flow for v in f.values()) and all(sum(f.values()) <= 2 * n for (n, _), f in zip(patterns, flow))
        best = (0, 0)
        ranges = [range(2 * n + 1) for n, src in patterns for _ in src]
        for amounts in itertools.product(*ranges):
            it = iter(amounts)
            f = [{s: next(it) for s in src} for _, src in patterns]
            if any(sum(g.values()) > 2 * n for (n, _), g in zip(patterns, f)):
                continue
            got = [sum(g.get(s, 0) for g in f) for s in range(3)]
            if all(x <= q for x, q in zip(got, quotas)):
                best = min(best, (-sum(got), cost(patterns, f, 2)))
        assert (-sum(into), cost(patterns, flow, 2)) == best


def test_overlapping_sources_meet_targets(spark):
    rng = random.Random(4)
    rows = [(d, rng.randint(1, 60), sorted(rng.sample(["a", "b", "c", "d"], rng.choice([1, 1, 2, 3])))) for d in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, n int, src array<string>")
    out = M.mix(docs, F.col("src"), F.col("n"), F.col("doc_id")).collect()
    assert len(out) == len(rows) and all(0 <= r["copies"] <= 3 and r.taken == r["size"] * r["copies"] for r in out)
    total = sum(n for _, n, _ in rows)
    assert abs(sum(r.taken for r in out) - total) <= 60 * 15
    again = M.mix(docs.repartition(9), F.col("src"), F.col("n"), F.col("doc_id")).collect()
    assert sorted((r.row.doc_id, r.taken) for r in out) == sorted((r.row.doc_id, r.taken) for r in again)


def test_each_source_comes_near_its_target(documents):
    rows = M.mix_documents(documents).select("row.source", "size", "source_size", "target", "taken").collect()
    for s in {r.source for r in rows}:
        part = [r for r in rows if r.source == s]
        assert sum(r["size"] for r in part) == part[0].source_size
        assert abs(sum(r.taken for r in part) - part[0].target) <= max(r["size"] for r in part)
        assert all(r.taken <= 3 * r["size"] for r in part)


def test_awkward_rows(awkward):
    out = M.mix_documents(awkward)
    assert out.count() == awkward.count()
    assert {r.size for r in out.where("row.text is null").select("size").collect()} == {0}
    taken = M.take_mix(awkward)
    assert taken.columns == awkward.columns
    assert taken.count() == out.agg(F.sum("copies")).first()[0]
    assert M.take_mix(awkward.limit(0)).count() == 0


def test_rows_of_one_ticket_spread_and_are_served_in_turn(spark):
    """A third of the rows has no id, hence one ticket: the rest runs out among them, no task
    ranks them all, and the words taken are those of the ranked list of all rows."""
    rows = [(None, " ".join(["w"] * (i % 5)), "a") for i in range(900)] + [(i, "x y z", ["a", "b"][i % 2]) for i in range(1_800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [M.mix_documents(docs.repartition(k)).select("row.doc_id", "size", "copies", "taken", "source_size", "target", F.col("row.source").alias("source")).collect() for k in (3, 11)]
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["copies"])
    assert sorted(map(key, got[0])) == sorted(map(key, got[1]))
    for source in ("a", "b"):
        mine = [r for r in got[0] if r["source"] == source]
        full, rest = divmod(int(mine[0]["target"]), mine[0]["source_size"])
        ticket = lambda r: hashlib.md5(f"mix-1:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()
        total, want = 0, []
        for r in sorted(mine, key=lambda r: (ticket(r), r["size"])):
            total += r["size"]
            want.append((ticket(r), r["size"], full + (rest > 0 and 2 * total - r["size"] <= 2 * rest)))
        assert sorted((ticket(r), r["size"], r["copies"]) for r in mine if r["size"]) == sorted(x for x in want if x[1])
