"""Conversation repair against an enumeration of all edit lists."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from cabline.llm import repair as R

PATTERN = re.compile("(s?(ua)+)?")


def cheapest(rows):
    """rows: (initial, fault). Cheapest (cost, edits) by widening whole lists row by row; a
    state keeps the least of its lists, which is safe, as no list begins another of its cost."""
    def inserted(ways):
        out = dict(ways)
        for _ in range(2):
            for said, (cost, edits) in list(out.items()):
                for c in "ua":
                    if re.fullmatch("s?(ua)*u?", said + c):
                        state = short(said + c)
                        out[state] = min(out.get(state, (10**9, "")), (cost + 5, edits + "I"))
        return out

    ways = {"": (0, "")}
    for initial, fault in rows:
        new = {}
        for said, (cost, edits) in inserted(ways).items():
            options = [("D", 2, "")]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                options += [("K", more, initial), ("R", 1 + more, "u"), ("R", 1 + more, "a")]
            for edit, price, c in options:
                if edit == "K" and c not in ("s", "u", "a"):
                    continue
                if re.fullmatch("s?(ua)*u?", said + c):
                    state = short(said + c)
                    new[state] = min(new.get(state, (10**9, "")), (cost + price, edits + edit))
        ways = new
    return min(way for said, way in inserted(ways).items() if PATTERN.fullmatch(said))


def short(said):
    return said if len(said) <= 2 else re.sub("(ua)+$", "ua", re.sub("(ua)+u$", "uau", said)).replace("uaua", "ua")


def code(initial, fault):
    return R.FAULTS.index(fault) * 4 + (R.INITIALS.index(initial) if initial in R.INITIALS else 0)


@pytest.mark.parametrize("seed", range(6))
def test_auction_finds_the_least_cheapest_edits(seed):
    rng = random.Random(seed)
    for _ in range(120):
        rows = [(rng.choice("suuaax"), rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randint(1, 14))]
        codes = bytes(code(*x) for x in rows)
        cut = rng.randint(1, len(codes))
        parts = [codes[a: a + cut] for a in range(0, len(codes), cut)]
        pieces = [[dict(zip(("enter", "leave", "cost", "edits"), x)) for x in R.solve_segment(c, i == 0, i == len(parts) - 1)] for i, c in enumerate(parts)]
        cost, ways = R.chain_segments(pieces)
        assert (cost, "".join(e for _, e in ways)) == cheapest(rows), rows
        said = ""
        for part, (enter, edits), own in zip(parts, ways, [rows[a: a + cut] for a in range(0, len(codes), cut)]):
            for (edit, new, before), row in zip(R.walk(part, enter, edits), [*own, ("", "")]):
                said += "".join(x[0] for x in before) + ("" if edit in ("D", "") else new[0] if new else row[0])
        assert PATTERN.fullmatch(said)


def test_prices_are_distances_and_long_conversations_stay_linear():
    rng = random.Random(1)
    rows = [(rng.choice("ua"), rng.choice(["", "", "truncated", "duplicate"])) for _ in range(3_000)]
    [(_, _, cost, edits)] = R.solve_segment(bytes(code(*x) for x in rows), True, True)
    assert (cost, edits) == cheapest(rows)


AWKWARD = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes"),
    (2, None, "user", "first."), (2, 5, "user", "second."), (2, 5, None, "third."),
    (3, 0, "assistant", None), (4, 0, "", " \n\t"), (None, 0, "user", "no conversation."), (None, 1, "assistant", "x" * 20_000 + "."),
    *[(9, t, "user" if t % 3 else "tool", f"turn {t % 50}{'.' if t % 7 else ''}") for t in range(400)],
]


def brute(turns):
    out = {}
    for conv in {r[0] for r in turns}:
        rows = sorted(((t is not None, t or 0, r or " " if r is None else r, " " if x is None else x) for c, t, r, x in turns if c == conv))
        seen, faults = set(), []
        for _, _, role, text in rows:
            body = text.rstrip(" \t\n\v\f\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, edits = cheapest([(r[2][:1], f) for r, f in zip(rows, faults)])
        said, state, left = [], R.NOTHING, iter(rows)
        for e in edits:
            row = None if e == "I" else next(left)
            if e == "D":
                continue
            state = R.SYSTEM if e == "K" and row[2][:1] == "s" else R.NEXT[state]
            said.append(f"{row[2] if e == 'K' else R.ROLES[state]}:{row[3] if row else ''}")
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        out[conv] = (*[faults.count(f) for f in R.FAULTS[1:]], illegal, cost, edits, hashlib.sha256("\n".join(said).encode()).hexdigest() if said else None)
    return out


@pytest.mark.parametrize("segment", [4_096, 7])
def test_whole_conversations(spark, segment):
    turns = spark.createDataFrame(AWKWARD, "conv_id long, turn long, role string, text string").withColumn("at", F.lit("mine")).withColumn("conv", F.lit(0))
    fixed = R.repair_conversations(turns.repartition(5), params=R.RepairParams(segment=segment))
    sums = {r["conv"]: r["sha256"] for r in R.digests(fixed.repaired()).collect()}
    got = {r["conv"]: (r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], sums.get(r["conv"]))
           for r in fixed.conversations.withColumn("audit", R.audit(F.col("steps"))).collect()}
    assert got == brute(AWKWARD)


def test_empty_table(spark):
    fixed = R.repair_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert fixed.conversations.count() == 0 and fixed.repaired().count() == 0 and R.digests(fixed.repaired()).count() == 0
