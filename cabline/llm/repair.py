"""Conversation structure repair: cheapest edits that make the roles alternate.

A conversation is to read ``(s?(ua)+)?`` by the initials of its roles. Each row is kept,
given another role, or deleted, and empty turns may be inserted. All ways to do so are the
paths of a lattice: a node is (rows handled, what was said last), an arc is one edit with an
integer cost. Cheapest paths come from the auction algorithm for shortest paths: every node
has a price, a path grows from an origin along the arc of least cost plus price, or shrinks
by one node whose price rises to that value, until it reaches a node that is known to lie on
a cheapest path. Origins are taken from the last row to the first, prices stay between
them. The converged prices are dual optimal, so exactly the arcs with
price = cost + price of the next node (the tight ones) lie on cheapest paths, and following
them by the least edit initial gives the lexicographically least cheapest edit list.

A conversation may hold any share of all rows: rows are numbered by range partitions, cut
into segments of bounded length, and each segment is solved for every pair of entry and
exit state. A conversation then only chains its segments' answers (a byte or so a row and
state); texts are not gathered for that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabline.operators.ranking import rank_within
from cabline.session import materialize

#: What was said last: nothing, the system turn, a user, an assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: State after a user or assistant turn that the pattern allows in a state.
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
#: Costs of the edits; an undeleted truncated row adds its own.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: Characters that are not text, and those that end a whole text.
BLANK = " \t\n\v\f\r"
ENDINGS = ".!?"

INITIALS = ("", "s", "u", "a")                    # 0 stands for any other role
FAULTS = ("", "blank", "duplicate", "truncated")  # code of a row: fault * 4 + initial
_FAR = 1 << 60


@dataclass(frozen=True)
class RepairParams:
    """segment: rows of a conversation that one lattice holds. remembered: rows of the
    segments whose answer a task keeps for equal ones. task: rows of a task that solves
    segments (their codes are small, so partitions by size would hold too many)."""

    segment: int = 4_096
    remembered: int = 32
    task: int = 20_000


def _row_arcs(code: int) -> tuple[tuple[tuple[str, int, int], ...], ...]:
    """For each state the edits of a row: (initial, cost, state after it)."""
    fault, initial = FAULTS[code // 4], INITIALS[code % 4]
    out = []
    for state in range(4):
        arcs = [("D", DELETE, state)]
        if fault not in ("blank", "duplicate"):
            extra = TRUNCATED if fault == "truncated" else 0
            if initial == "s" and state == NOTHING:
                arcs.append(("K", KEEP + extra, SYSTEM))
            elif initial and ROLES[NEXT[state]].startswith(initial):
                arcs.append(("K", KEEP + extra, NEXT[state]))
            arcs.append(("R", REROLE + extra, NEXT[state]))
        out.append(tuple(arcs))
    return tuple(out)


_ARCS = tuple(_row_arcs(code) for code in range(4 * len(FAULTS)))


class Lattice:
    """Nodes 4 * rows handled + state. The last segment ends in one more node, reached from
    the states in which a conversation may end, after inserts behind the last row."""

    def __init__(self, codes: bytes, last: bool):
        self.codes, self.last, self.end = codes, last, 4 * (len(codes) + 1)
        self.price = [0] * (self.end + 1)
        self.settled = [False] * (self.end + 1)

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        at, state = divmod(node, 4)
        if at < len(self.codes):
            out = [(edit, cost, 4 * at + 4 + to) for edit, cost, to in _ARCS[self.codes[at]][state]]
        elif not self.last:
            return []                               # inserts here belong to the next segment
        else:
            out = [("", 0, self.end)] if state in (NOTHING, ASSISTANT) else []
        out.append(("I", INSERT, 4 * at + NEXT[state]))
        return out

    def auction(self, origin: int) -> None:
        """Settles ``origin``: its price becomes its distance to the settled target (_FAR if
        no path leads there). Prices never exceed cost plus price along an arc, and meet it
        on the path."""
        price, settled, path = self.price, self.settled, [origin]
        while not settled[path[-1]]:
            node = path[-1]
            best, to = _FAR, None
            for _, cost, target in self.arcs(node):
                if cost + price[target] < best:
                    best, to = cost + price[target], target
            if price[node] < best:                  # contract: the price rises
                price[node] = best
                if len(path) > 1:
                    path.pop()
                elif best == _FAR:
                    break
            elif to is None:
                break
            else:                                   # extend along a tight arc
                path.append(to)
        for node in path:
            settled[node] = True

    def solve(self, target: int) -> None:
        """Distances of all nodes to ``target``. What a state can never lead to is known
        before: nothing comes back to NOTHING, and no turn to SYSTEM. Without that, the two
        inserts of such a column would raise each other's prices for ever."""
        self.settled[target] = True
        leave = NOTHING if target == self.end else target % 4
        if target != self.end and leave in (NOTHING, SYSTEM):
            for node in range(self.end):
                if node % 4 > leave:
                    self.price[node], self.settled[node] = _FAR, True
        for origin in range(self.end - 1, -1, -1):
            if not self.settled[origin]:
                self.auction(origin)

    def trace(self, node: int, target: int) -> str:
        """Least edit list among the tight paths from a settled node."""
        out = []
        while node != target:
            edit, _, node = min(a for a in self.arcs(node) if self.price[node] == a[1] + self.price[a[2]])
            out.append(edit)
        return "".join(out)


def solve_segment(codes: bytes, first: bool, last: bool) -> list[tuple[int, int, int, str]]:
    """(entry state, exit state, cost, edits) of every pair that a path joins; the exit of a
    last segment is NOTHING for all."""
    out = []
    for leave in (NOTHING,) if last else range(4):
        lattice = Lattice(codes, last)
        target = lattice.end if last else 4 * len(codes) + leave
        lattice.solve(target)
        for enter in (NOTHING,) if first else range(4):
            if lattice.price[enter] < _FAR:
                out.append((enter, leave, lattice.price[enter], lattice.trace(enter, target)))
    return out


@lru_cache(maxsize=1 << 14)
def _remembered(codes: bytes, first: bool, last: bool) -> list[tuple[int, int, int, str]]:
    return solve_segment(codes, first, last)


_PIECES = "codes array<int>, pieces array<struct<enter:int,leave:int,cost:bigint,edits:string>>, illegal bigint, head int, tail int"
_LEGAL = {(1, 2), (2, 3), (3, 2)}                   # su, ua, au


def _solve(p: RepairParams):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            pieces, illegal, head, tail = [], [], [], []
            for codes, first, last in zip(batch.column("codes").to_pylist(), batch.column("first").to_pylist(), batch.column("last").to_pylist()):
                codes = bytes(codes)
                found = (_remembered if len(codes) <= p.remembered else solve_segment)(codes, first, last)
                pieces.append([dict(zip(("enter", "leave", "cost", "edits"), x)) for x in found])
                said = [c % 4 for c in codes]
                illegal.append(sum(x not in _LEGAL for x in zip(said, said[1:])))
                head.append(said[0])
                tail.append(said[-1])
            kind = pa.list_(pa.struct([("enter", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("seg"), batch.column("codes"), pa.array(pieces, kind), pa.array(illegal, pa.int64()), pa.array(head, pa.int32()), pa.array(tail, pa.int32())],
                names=["conv", "seg", "codes", "pieces", "illegal", "head", "tail"])

    return run


def chain_segments(segments: list[list[dict]]) -> tuple[int, list[tuple[int, str]]]:
    """Cost of the cheapest edits of a conversation and (entry state, edits) per segment.

    Edits of a segment end with a row's edit and hold one for each row, so none is the
    beginning of another: comparing them segment by segment is comparing the whole lists."""
    best: dict[int, tuple[int, str, int]] = {}
    plans = []
    for i, pieces in enumerate(reversed(segments)):
        now: dict[int, tuple[int, str, int]] = {}
        for x in pieces:
            if i and x["leave"] not in best:
                continue
            option = (x["cost"] + (best[x["leave"]][0] if i else 0), x["edits"], x["leave"])
            now[x["enter"]] = min(option, now.get(x["enter"], option))
        best = now
        plans.append(now)
    state, out = NOTHING, []
    for plan in reversed(plans):
        out.append((state, plan[state][1]))
        state = plan[state][2]
    return plans[-1][NOTHING][0], out


def _chain(batches: Iterator[pa.RecordBatch]):
    kind = pa.list_(pa.struct([("seg", pa.int64()), ("enter", pa.int32()), ("edits", pa.string()), ("codes", pa.list_(pa.int32()))]))
    for batch in batches:
        for k in range(batch.num_rows):               # one conversation at a time
            parts = batch.column("parts")[k].as_py()
            cost, ways = chain_segments([x["pieces"] for x in parts])
            illegal = sum(x["illegal"] for x in parts) + sum((a["tail"], b["head"]) not in _LEGAL for a, b in zip(parts, parts[1:]))
            steps = [{"seg": x["seg"], "enter": e, "edits": s, "codes": x["codes"]} for x, (e, s) in zip(parts, ways)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv").slice(k, 1), pa.array([cost], pa.int64()), pa.array([illegal], pa.int64()), pa.array([steps], kind)],
                names=["conv", "cost", "illegal", "steps"])


def walk(codes: bytes, enter: int, edits: str) -> Iterator[tuple[str, str | None, list[str]]]:
    """(edit, new role, roles inserted before it) of each row of a segment; last, with an
    empty edit, the roles inserted behind it."""
    state, before, rows = enter, [], iter(codes)
    for edit in edits:
        if edit == "I":
            state = NEXT[state]
            before.append(ROLES[state])
            continue
        code = next(rows)
        if edit != "D":
            state = SYSTEM if edit == "K" and INITIALS[code % 4] == "s" else NEXT[state]
        yield edit, ROLES[state] if edit == "R" else None, before
        before = []
    yield "", None, before


def _expand(p: RepairParams):
    """(conv, seg, codes, enter, edits) to (conv, at, edit, new_role, inserted) by row; the
    inserts behind the last row have a row of their own with an empty edit."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("seg", "codes", "enter", "edits")}
                steps = list(walk(bytes(row["codes"]), row["enter"], row["edits"]))
                if not steps[-1][2]:
                    steps.pop()
                start = row["seg"] * p.segment + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("conv")[k].as_py()] * len(steps), batch.column("conv").type),
                    pa.array(range(start, start + len(steps)), pa.int64()), pa.array([x[0] for x in steps], pa.string()),
                    pa.array([x[1] for x in steps], pa.string()), pa.array([x[2] for x in steps], pa.list_(pa.string()))],
                    names=["conv", "at", "edit", "new_role", "inserted"])

    return run


def _faults(rows: DataFrame) -> DataFrame:
    """Adds ``fault`` (first that applies) and ``code`` to the numbered rows."""
    text = F.rtrim("text", F.lit(BLANK))
    said = F.sha2(F.concat(F.to_json(F.struct("conv")), F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = rows.withColumn("said", said)
    first = rows.groupBy("said").agg(F.min("at").alias("first_at"))     # combines before the shuffle
    rows = rows.join(first, "said").drop("said")
    fault = (F.when(text == "", "blank").when(F.col("at") > F.col("first_at"), "duplicate")
             .when(~F.right(text, F.lit(1)).isin(*ENDINGS), "truncated").otherwise(""))
    initial = F.left("role", F.lit(1))
    known = F.array_position(F.lit(list(INITIALS[1:])), initial).cast("int")
    return (rows.withColumn("fault", fault)
            .withColumn("code", ((F.array_position(F.lit(list(FAULTS)), F.col("fault")) - 1) * 4 + known).cast("int"))
            .drop("first_at"))


@dataclass(frozen=True)
class Repair:
    """conversations: conv, blank, duplicate, truncated, illegal, cost, steps. rows: conv,
    at (place in the conversation, from 1), edit, role and text by then, new_role, inserted;
    one row has an empty edit where turns are inserted behind the last one."""

    conversations: DataFrame
    rows: DataFrame

    def repaired(self) -> DataFrame:
        """(conv, at, part, role, text): the turns that the edits give, in the order of at
        and part."""
        added = self.rows.select("conv", "at", F.posexplode("inserted").alias("part", "role"), F.lit("").alias("text"))
        kept = self.rows.where("edit IN ('K', 'R')").select(
            "conv", "at", F.size("inserted").alias("part"), F.coalesce("new_role", "role").alias("role"), "text")
        return kept.unionByName(added)


def repair_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", params: RepairParams | None = None) -> Repair:
    """Cheapest repair of every conversation.

    Rows stand in the order of turn (nulls first), then role and text; equal rows are equal
    in every result. Faults: blank (no text), duplicate (role and text stand earlier in the
    conversation), truncated (does not end in one of ``.!?``). A null role or text is one
    space: blank, and no known initial. A null conversation is one like any other. Texts
    travel whole but are compared by SHA-256; conversations of any length are cut into
    segments. Only the four columns are read, so others may have any name. An empty table
    gives empty results.
    """
    p, spark = params or RepairParams(), turns.sparkSession
    slim = turns.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))
    rows = rank_within(slim, ["conv"], [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")])
    rows = materialize(_faults(rows.withColumnsRenamed({"_rn": "at", "_n": "rows"})), "turns")

    tasks = max(spark.sparkContext.defaultParallelism, rows.count() // p.task)
    seg = F.floor((F.col("at") - 1) / p.segment).alias("seg")
    cut = rows.select("conv", seg, "at", "code", "rows").repartition(tasks, "conv", "seg").groupBy("conv", "seg").agg(   # at most ``segment`` rows a group
        F.sort_array(F.collect_list(F.struct("at", "code"))).getField("code").alias("codes"), F.max("rows").alias("rows"))
    cut = cut.select("conv", "seg", "codes", (F.col("seg") == 0).alias("first"),
                     (F.col("seg") == F.floor((F.col("rows") - 1) / p.segment)).alias("last"))
    kind = T.StructType([slim.schema["conv"], T.StructField("seg", T.LongType())])
    solved = cut.mapInArrow(_solve(p), T.StructType([*kind, *T.StructType.fromDDL(_PIECES)]))
    chained = solved.repartition(tasks, "conv").groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("seg", "illegal", "head", "tail", "codes", "pieces"))).alias("parts"))
    steps = "cost bigint, illegal bigint, steps array<struct<seg:bigint,enter:int,edits:string,codes:array<int>>>"
    chained = materialize(chained.mapInArrow(_chain, T.StructType([slim.schema["conv"], *T.StructType.fromDDL(steps)])), "repairs")

    each = chained.select("conv", F.inline("steps")).repartition(tasks, "conv", "seg")
    edits = each.mapInArrow(_expand(p), T.StructType([slim.schema["conv"], *T.StructType.fromDDL("at bigint, edit string, new_role string, inserted array<string>")]))
    done = edits.alias("e").join(rows.alias("r"), F.expr("e.conv <=> r.conv AND e.at = r.at"), "left").select("e.*", "r.turn", "r.role", "r.text", "r.fault")
    counts = rows.groupBy("conv").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in FAULTS[1:]])
    whole = counts.alias("a").join(chained.alias("b"), F.expr("a.conv <=> b.conv")).select("a.*", "b.illegal", "b.cost", "b.steps")
    return Repair(whole, done)


def audit(steps: Column) -> Column:
    """The initials of all edits of a conversation in order."""
    return F.array_join(F.transform(steps, lambda s: s["edits"]), "")


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, sha256): SHA-256 of the conversation's repaired ``role:text``, joined by line
    breaks. Turns pass one after another, sorted within the task, and are never held."""

    def run(batches):
        conv, running, named = None, None, pa.array([], pa.null())
        for batch in batches:
            out, sums = [], []
            for k, (role, text) in enumerate(zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())):
                now = batch.column("conv")[k].as_py()
                if running is None or now != conv:
                    if running is not None:
                        out.append(conv)
                        sums.append(running.hexdigest())
                    conv, running = now, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode())
            named = batch.column("conv").type
            yield pa.RecordBatch.from_arrays([pa.array(out, named), pa.array(sums, pa.string())], names=["conv", "sha256"])
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], named), pa.array([running.hexdigest()])], names=["conv", "sha256"])

    ordered = repaired.repartition("conv").sortWithinPartitions("conv", "at", "part")
    return ordered.mapInArrow(run, T.StructType([repaired.schema["conv"], T.StructField("sha256", T.StringType())]))
