"""LM scoring: a hashed maximum-entropy model with class-factored softmax.

Every word belongs to a slot: the most frequent words have one each, all others share the
rest by hash. A slot is a (class, member) pair and

    P(word | context) = P(class | context) P(member | class, context) P(word | slot)

The first two are softmax functions of sums of weight rows: one row each for the previous
word, the word before it (a skip feature) and the pair, hashed into a fixed table; the
member rows are hashed together with the class. Both start from the corpus frequencies. The
last factor is the word's smoothed share of its slot. A text's score is the sum of log10
over its words and one end mark.

Counts cover all training texts. Weights are trained in every partition by gradient steps
from the same start and averaged by tokens, for ``rounds`` rounds. Counts of the most
frequent words (a bounded number) travel to the scoring tasks; the others are joined by word,
so no part needs the whole vocabulary.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabline.llm import common as C
from cabline.session import materialize_at

END = np.uint64(0x517CC1B727220A95)        # stands for the end of a text
START = np.uint64(0x2545F4914F6CDD1D)      # context before its first word


@dataclass(frozen=True)
class LmParams:
    """classes, members: sides of the slot table. own: words with a slot of their own.
    rows: weight rows of each softmax. batch: tokens of a gradient step. rate: step size.
    rounds: passes of distributed training. head: counts that travel to the tasks, at most."""

    classes: int = 16
    members: int = 16
    own: int = 128
    rows: int = 4_096
    batch: int = 4_096
    rate: float = 0.25
    rounds: int = 1
    head: int = 131_072
    chunks: int = 16
    spread: int = 64

    @property
    def slots(self) -> int:
        return self.classes * self.members


def token_stream(raw: np.ndarray, off: np.ndarray):
    """Hashes of all tokens of all rows (words with A-Z lowered, then one end), and row
    pointers into them."""
    _, _, h, ptr = C.tokens(raw, off, lower=True)
    n = len(off) - 1
    out_ptr = ptr + np.arange(n + 1)
    out = np.empty(len(h) + n, np.uint64)
    ends = out_ptr[1:] - 1
    word = np.ones(len(out), bool)
    word[ends] = False
    out[ends], out[word] = END, h
    return out, out_ptr


def _streams(batch):
    raw, off = C.text_buffers(batch.column("text"))
    for a, b in C.slices(off):
        yield a, b, *token_stream(raw[off[a]: off[b]], off[a: b + 1] - off[a])


def _count(batches):
    """Token counts, combined per batch slice before the shuffle."""
    for batch in batches:
        for _, _, tok, _ in _streams(batch):
            word, n = np.unique(tok, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(C.signed(word)), pa.array(n.astype(np.int64))], names=["word", "n"])


class Slots:
    """Slot of each word, and what the tasks need to know of the counts."""

    def __init__(self, p: LmParams, own: np.ndarray, head: np.ndarray, head_n: np.ndarray, slot_n: np.ndarray, slot_v: np.ndarray) -> None:
        self.p = p
        order = np.argsort(own)
        self.own, self.own_slot = own[order], order.astype(np.int64)
        order = np.argsort(head)
        self.head, self.head_n = head[order], head_n[order].astype(np.float64)
        self.size = slot_n + 0.5 * (slot_v + 1)
        share = (slot_n + 0.5).reshape(p.classes, p.members)
        self.class_bias = np.log(share.sum(axis=1) / share.sum()).astype(np.float32)
        self.member_bias = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)

    def slot(self, tok: np.ndarray) -> np.ndarray:
        p = self.p
        rest = max(1, p.slots - len(self.own))
        out = np.minimum(len(self.own), p.slots - 1) + (C.mix64(tok) % np.uint64(rest)).astype(np.int64)
        if len(self.own):
            at = np.minimum(np.searchsorted(self.own, tok), len(self.own) - 1)
            out = np.where(self.own[at] == tok, self.own_slot[at], out)
        return out

    def head_count(self, tok: np.ndarray) -> np.ndarray:
        """Count of a head word, -1 of any other."""
        if not len(self.head):
            return np.full(len(tok), -1.0)
        at = np.minimum(np.searchsorted(self.head, tok), len(self.head) - 1)
        return np.where(self.head[at] == tok, self.head_n[at], -1.0)


def contexts(tok: np.ndarray, ptr: np.ndarray, rows: int) -> np.ndarray:
    """Weight rows of the three features of each token."""
    one, two = np.empty_like(tok), np.empty_like(tok)
    one[1:], two[2:] = tok[:-1], tok[:-2]
    first = ptr[:-1]
    second = first + 1
    second = second[second < ptr[1:]]
    one[first], two[first], two[second] = START, START, START
    f = np.stack([C.mix64(one + np.uint64(1)), C.mix64(two + np.uint64(2)), C.mix64(one * np.uint64(3) + C.mix64(two + np.uint64(3)))])
    return (f % np.uint64(rows)).astype(np.int64)


def member_rows(f: np.ndarray, cls: np.ndarray, rows: int) -> np.ndarray:
    return (C.mix64((f * 64 + 7).astype(np.uint64) + (cls + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(rows)).astype(np.int64)


def _softmax(weights: np.ndarray, bias: np.ndarray, f: np.ndarray) -> np.ndarray:
    z = weights[f[0]]
    z += weights[f[1]]
    z += weights[f[2]]
    z += bias
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def _step(weights: np.ndarray, f: np.ndarray, grad: np.ndarray, rate: float) -> None:
    """Move every touched row against the mean gradient of the tokens that touch it."""
    for row in f:
        order = np.argsort(row, kind="stable")
        r = row[order]
        first = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        n = np.diff(np.append(first, len(r)))
        weights[r[first]] -= (rate * np.add.reduceat(grad[order], first, axis=0) / (n[:, None] + 4)).astype(np.float32)


def train_block(w1: np.ndarray, w2: np.ndarray, slots: Slots, tok: np.ndarray, ptr: np.ndarray) -> None:
    p = slots.p
    f_all, slot = contexts(tok, ptr, p.rows), slots.slot(tok)
    for i in range(0, len(tok), p.batch):
        f, s = f_all[:, i: i + p.batch], slot[i: i + p.batch]
        cls, mem = s // p.members, s % p.members
        at = np.arange(len(s))
        q = _softmax(w1, slots.class_bias, f)
        q[at, cls] -= 1
        _step(w1, f, q, p.rate)
        g = np.stack([member_rows(x, cls, p.rows) for x in f])
        q = _softmax(w2, slots.member_bias[cls], g)
        q[at, mem] -= 1
        _step(w2, g, q, p.rate)


def model_log10(w1: np.ndarray, w2: np.ndarray, slots: Slots, tok: np.ndarray, ptr: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """log10 P(slot | context) of every token."""
    p = slots.p
    f_all, out = contexts(tok, ptr, p.rows), np.empty(len(tok))
    for i in range(0, len(tok), 4 * p.batch):
        f, s = f_all[:, i: i + 4 * p.batch], slot[i: i + 4 * p.batch]
        cls, mem = s // p.members, s % p.members
        at = np.arange(len(s))
        a = _softmax(w1, slots.class_bias, f)[at, cls]
        b = _softmax(w2, slots.member_bias[cls], np.stack([member_rows(x, cls, p.rows) for x in f]))[at, mem]
        out[i: i + len(s)] = np.log10(np.maximum(a.astype(np.float64) * b, 1e-300))
    return out


def _train(slots: Slots, w1: np.ndarray, w2: np.ndarray):
    """Each partition's change of the weights times its tokens, in chunks."""
    p = slots.p

    def run(batches):
        a, b, tokens = w1.copy(), w2.copy(), 0
        for batch in batches:
            for _, _, tok, ptr in _streams(batch):
                train_block(a, b, slots, tok, ptr)
                tokens += len(tok)
        if not tokens:
            return
        change = (np.concatenate([a - w1, b - w2], axis=1).astype(np.float64) * tokens)
        who = int(C.mix64(np.array([tokens], np.uint64))[0] % np.uint64(p.spread))
        for k, part in enumerate(np.array_split(change, p.chunks)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([who], pa.int32()), pa.array([tokens], pa.int64()), pa.array([part.astype(np.float32).tobytes()], pa.binary())],
                names=["chunk", "who", "tokens", "change"])

    return run


def _add(t: pa.Table) -> pa.Table:
    order = np.argsort(t["tokens"].to_numpy(), kind="stable")
    parts = t["change"].to_pylist()
    total = np.zeros(len(parts[0]) // 4, np.float64)
    for k in order:
        total += np.frombuffer(parts[k], np.float32)
    return pa.table({"chunk": pa.array([t["chunk"][0].as_py()], pa.int32()), "who": pa.array([0], pa.int32()),
                     "tokens": pa.array([int(t["tokens"].to_numpy().sum())], pa.int64()), "change": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


@dataclass
class LanguageModel:
    """slots: slot and head counts; w1, w2: weights; tokens, words: training tokens (N) and
    distinct ones (V); counts: table (word hash, n) of all training tokens."""

    slots: Slots
    w1: np.ndarray
    w2: np.ndarray
    tokens: int
    words: int
    counts: DataFrame
    path: str


def train_lm(docs: DataFrame, params: LmParams | None = None) -> LanguageModel:
    """Counts and weights from the column ``text`` of all rows of ``docs`` (null: empty)."""
    p = params or LmParams()
    schema = "word long, n long"
    counts, path = materialize_at(
        docs.select("text").mapInArrow(_count, schema).groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    size = counts.agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    # the largest counts that fit the head: how many words have at least 2**k or so
    level = F.floor(F.log2("n") * 16).cast("int")
    steps = counts.groupBy(level.alias("level")).agg(F.count("*").alias("k")).orderBy(F.desc("level")).collect()
    room, least = p.head, None
    for s in steps:
        if s["k"] > room:
            break
        room, least = room - s["k"], s["level"]
    head = counts.where(level >= least).toArrow() if least is not None else counts.limit(0).toArrow()
    words = head["word"].to_numpy().astype(np.int64).view(np.uint64)
    n = head["n"].to_numpy().astype(np.int64)
    top = np.lexsort((words, -n))[: p.own]
    own = words[top]
    slots = Slots(p, own, words, n, np.zeros(p.slots), np.zeros(p.slots))

    def by_slot(batches):
        for batch in batches:
            s = slots.slot(batch.column("word").to_numpy().view(np.uint64))
            k = batch.column("n").to_numpy().astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(p.slots)), pa.array(np.bincount(s, k, minlength=p.slots).astype(np.int64)), pa.array(np.bincount(s, minlength=p.slots).astype(np.int64))],
                names=["slot", "n", "v"])

    slot_n, slot_v = np.zeros(p.slots), np.zeros(p.slots)
    for r in counts.mapInArrow(by_slot, "slot long, n long, v long").groupBy("slot").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        slot_n[r["slot"]], slot_v[r["slot"]] = r["n"], r["v"]
    slots = Slots(p, own, words, n, slot_n, slot_v)
    w1, w2 = np.zeros((p.rows, p.classes), np.float32), np.zeros((p.rows, p.members), np.float32)
    for _ in range(p.rounds):
        grads = docs.select("text").mapInArrow(_train(slots, w1, w2), "chunk int, who int, tokens long, change binary")
        for keys in (["chunk", "who"], ["chunk"]):
            grads = grads.groupBy(*keys).applyInArrow(_add, "chunk int, who int, tokens long, change binary")
        parts = sorted(grads.collect(), key=lambda r: r["chunk"])      # as large as the weights
        if parts:
            change = np.concatenate([np.frombuffer(r["change"], np.float32).reshape(-1, p.classes + p.members) / r["tokens"] for r in parts])
            w1, w2 = w1 + change[:, : p.classes], w2 + change[:, p.classes:]
    return LanguageModel(slots, w1.astype(np.float32), w2.astype(np.float32), int(size["n"] or 0), int(size["v"]), counts, path)


SCORED = ("rid long, n_tokens long, n_known long, known_log double, model_log double, slot_log double, "
          "rare array<struct<word: long, n: int>>")


def _score(m: LanguageModel):
    slots, w1, w2 = m.slots, m.w1, m.w2
    rare_type = pa.struct([("word", pa.int64()), ("n", pa.int32())])

    def run(batches):
        for batch in batches:
            for a, b, tok, ptr in _streams(batch):
                slot = slots.slot(tok)
                c = slots.head_count(tok)
                known = c >= 0
                add = lambda x: np.add.reduceat(x, ptr[:-1]) if len(ptr) > 1 else np.empty(0)
                model = model_log10(w1, w2, slots, tok, ptr, slot)
                row = np.repeat(np.arange(b - a), np.diff(ptr))
                # other words: once per text, with their number
                r, t = row[~known], tok[~known]
                order = np.lexsort((t, r))
                r, t = r[order], t[order]
                new = np.ones(len(r), bool)
                new[1:] = (r[1:] != r[:-1]) | (t[1:] != t[:-1])
                first = np.flatnonzero(new)
                count = np.diff(np.append(first, len(r))).astype(np.int32)
                rptr = np.searchsorted(r[first], np.arange(b - a + 1)).astype(np.int32)
                rare = pa.StructArray.from_arrays([pa.array(C.signed(t[first])), pa.array(count)], fields=list(rare_type))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(a, b - a), batch.column("rid").slice(a, b - a), pa.array(np.diff(ptr).astype(np.int64)),
                     pa.array(add(known.astype(np.int64))), pa.array(add(np.where(known, np.log10(np.maximum(c, 0) + 0.5), 0.0))),
                     pa.array(add(model)), pa.array(add(np.log10(slots.size)[slot])), pa.ListArray.from_arrays(pa.array(rptr), rare)],
                    names=["row", "rid", "n_tokens", "n_known", "known_log", "model_log", "slot_log", "rare"])

    return run


def score_lm(docs: DataFrame, model: LanguageModel, columns: list[str] | None = None) -> DataFrame:
    """Struct ``row`` (``columns`` of ``docs``, all by default) with n_tokens, n_known (tokens
    seen in training), base_score (smoothed unigram log10) and score (the model's log10).

    A null text is an empty one: a single end token. Equal texts score equally; every row
    has its own result; texts of any length are scored whole. An empty table gives an empty
    result. The input's columns are inside ``row``, so none can clash with the scores."""
    cols = docs.columns if columns is None else columns
    slim = docs.select(F.struct(*[docs[f"`{c}`"] for c in cols]).alias("row"), F.monotonically_increasing_id().alias("rid"), "text")
    part, _ = materialize_at(slim.mapInArrow(_score(model), C.row_schema(slim, SCORED)), "lm-scores")
    rare = part.select("rid", F.explode("rare").alias("x")).select("rid", "x.word", F.col("x.n").alias("k"))
    rare = rare.join(model.counts, "word", "left").groupBy("rid").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_log"),
        F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("rare_known"))
    out = part.drop("rare").join(rare, "rid", "left")
    words = F.col("known_log") + F.coalesce("rare_log", F.lit(0.0))
    return out.select(
        "row", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        (words - F.col("n_tokens") * float(np.log10(model.tokens + 0.5 * (model.words + 1)))).alias("base_score"),
        (F.col("model_log") + words - F.col("slot_log")).alias("score"))


def may_train(doc_id: Column) -> Column:
    return ~C.held_out(doc_id, 1)
