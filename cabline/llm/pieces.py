"""SentencePiece encoding and decoding with N-best segmentation.

A text becomes a lattice whose edges are the pieces of a model, scored by the model (a
character that no piece holds is an edge of its own, spelled in byte pieces). Forward
Viterbi scores are the exact heuristic of a backward A* search, which therefore pops the
best segmentations in order and never needs more open paths than segmentations still
wanted.

No piece holds a space after another character, and a line break is in no piece, so every
path passes through the nodes there: the lattice is a chain of short *segments* (a space
with the word after it). Equal segments of a batch are solved once, many at a time: forward
and backward scores, the best path, and the loss of the second best path (the best path
through any edge off the best one). The N best paths of a text differ from its best one
only in the segments that lose least, so the A* search runs in those alone.

The space is escaped as in the model's own normalisation and one is put before the text;
nothing else is changed, so decoding gives back every text exactly, the escape character
itself included (it is spelled in bytes).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabline.llm import common as C

ESCAPE = "▁"
#: Segments longer than this are solved one at a time.
WIDE = 64
#: Bytes of text whose segments are solved together (the more, the more are equal).
SLICE_BYTES = 2 << 20
#: Ids that one step of decoding handles.
SLICE_IDS = 1 << 19
NONE = -1e300


@dataclass(frozen=True)
class PieceParams:
    """model: path of a SentencePiece model, read on the driver. nbest: segmentations per
    text. penalty: score of an unknown character below the lowest piece."""

    model: str = "/opt/tokenizers/piece_bpe_32k.model"
    nbest: int = 4
    penalty: float = 10.0


class Pieces:
    """Pieces of a model as byte strings (spaces unescaped) with scores and ids."""

    def __init__(self, proto: bytes, penalty: float) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = sp.get_piece_size()
        self.text: list[bytes] = [b""] * n
        self.ids: dict[bytes, int] = {}
        self.scores: dict[bytes, float] = {}
        self.byte_ids = np.full(256, sp.unk_id(), np.int32)
        alphabet = set()
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.text[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                raw = piece.replace(ESCAPE, " ").encode()
                self.text[i] = raw
                self.ids[raw], self.scores[raw] = i, sp.get_score(i)
                alphabet.update(piece)
        usual = [s for s in self.scores.values() if s > -1e8]
        self.unknown = min(usual, default=0.0) - penalty
        self.longest = max(map(len, self.ids), default=1)
        self.prefixes = {p[:k] for p in self.ids for k in range(1, len(p) + 1)}
        #: bytes at which the lattice always has a node on both sides
        self.lone = b"" if "\n" in alphabet else b"\n"
        self.splits = not any(b" " in p.lstrip(b" ") for p in self.ids)
        # lookup table by hash, open addressing
        self.keys = np.array([_hash_one(p) for p in self.ids], np.uint64)
        self.key_id = np.array(list(self.ids.values()), np.int32)
        self.key_score = np.array([self.scores[p] for p in self.ids])
        #: score by index; the last two stand for an unknown character (-2) and no edge (-1)
        self.edge_score = np.concatenate([self.key_score, [self.unknown, NONE]])
        self.bits = 20
        self.slot = np.full(1 << self.bits, -1, np.int32)
        self.probes = 1
        for k, key in enumerate(self.keys):
            at, tries = int(key >> np.uint64(64 - self.bits)), 1
            while self.slot[at] >= 0:
                at, tries = (at + 1) & ((1 << self.bits) - 1), tries + 1
            self.slot[at] = k
            self.probes = max(self.probes, tries)
        # all pieces in one buffer, for decoding
        self.length = np.array([len(t) for t in self.text], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.buffer = np.frombuffer(b"".join(self.text) or b"\0", np.uint8)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of the piece with each hash, -1 where there is none."""
        at = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        k = self.slot[at]
        out = np.where((k >= 0) & (self.keys[k] == keys), k, -1)
        more = np.flatnonzero((k >= 0) & (out < 0))
        for _ in range(self.probes - 1):
            if not len(more):
                break
            at[more] = (at[more] + 1) & ((1 << self.bits) - 1)
            k = self.slot[at[more]]
            hit = (k >= 0) & (self.keys[k] == keys[more])
            out[more[hit]] = k[hit]
            more = more[(k >= 0) & ~hit]
        return out

    # -- one segment ------------------------------------------------------------------

    def edges(self, seg: bytes) -> list[list[tuple[int, float, int]]]:
        """For each end position: (start, score, piece id or -1 for an unknown character)."""
        n = len(seg)
        into: list[list[tuple[int, float, int]]] = [[] for _ in range(n + 1)]
        i = 0
        while i < n:
            size = _char_size(seg[i])
            single = False
            for k in range(1, min(self.longest, n - i) + 1):
                piece = seg[i: i + k]
                if piece not in self.prefixes:
                    break
                if piece in self.ids:
                    into[i + k].append((i, self.scores[piece], self.ids[piece]))
                    single |= k == size
            if not single:
                into[min(n, i + size)].append((i, self.unknown, -1))
            i += size
        for e in into:
            e.sort(key=lambda x: -x[0])                # shortest piece first
        return into

    def spell(self, seg: bytes, path: list[tuple[int, int, int]]) -> list[int]:
        out: list[int] = []
        for start, end, piece in path:
            out.extend([piece] if piece >= 0 else self.byte_ids[list(seg[start:end])].tolist())
        return out

    def forward(self, into) -> list[float]:
        best = [NONE] * len(into)
        best[0] = 0.0
        for j, edges in enumerate(into):
            for i, s, _ in edges:
                if best[i] + s > best[j]:
                    best[j] = best[i] + s
        return best

    def nbest(self, seg: bytes, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations (score, ids), best first; equal scores: the one whose
        last pieces are shorter first."""
        into = self.edges(seg)
        ahead = self.forward(into)
        heap: list = [(-ahead[-1], 0, 0, len(seg), 0.0, None)]
        out, step = [], 0
        while heap and len(out) < n:
            _, _, _, j, done, link = heapq.heappop(heap)
            if j == 0:
                path = []
                while link is not None:
                    path.append(link[0])
                    link = link[1]
                out.append((done, self.spell(seg, path)))
                continue
            step += 1
            for i, s, piece in into[j]:
                if ahead[i] > NONE / 2:
                    heapq.heappush(heap, (-(done + s + ahead[i]), -step, j - i, i, done + s, ((i, j, piece), link)))
            if len(heap) > 4 * n:                      # the heuristic is exact: only so many can still win
                heap = heapq.nsmallest(n - len(out), heap)
        return out

    # -- many segments ----------------------------------------------------------------

    def solve(self, body: np.ndarray, start: np.ndarray, size: np.ndarray):
        """Best ids of each segment body[start: start + size] as (flat ids, begin, count),
        its best score, and the loss of the second best path (infinite without one)."""
        n = len(start)
        score, loss = np.zeros(n), np.full(n, np.inf)
        begin, count = np.zeros(n, np.int64), np.zeros(n, np.int64)
        flats, used = [], 0
        body = np.concatenate([body, np.zeros(WIDE, np.uint8)])
        edges = (0, 3, 5, 7, 9, 11, 13, 16, 20, 24, 32, 48, WIDE)
        for lo, hi in zip(edges[:-1], edges[1:]):
            group = np.flatnonzero((size > lo) & (size <= hi))
            for a in range(0, len(group), 8192):
                at = group[a: a + 8192]
                raw = body[start[at][None, :] + np.arange(hi)[:, None]]
                flat, count[at], score[at], loss[at] = self._solve_block(raw, size[at])
                begin[at] = used + np.cumsum(count[at]) - count[at]
                flats.append(flat)
                used += len(flat)
        for k in np.flatnonzero(size > WIDE):
            two = self.nbest(body[start[k]: start[k] + size[k]].tobytes(), 2)
            flats.append(np.array(two[0][1], np.int32))
            score[k], begin[k], count[k] = two[0][0], used, len(flats[-1])
            used += count[k]
            if len(two) > 1:
                loss[k] = two[0][0] - two[1][0]
        return np.concatenate(flats) if flats else np.empty(0, np.int32), begin, count, score, loss

    def _solve_block(self, raw: np.ndarray, size: np.ndarray):
        """raw: bytes of the segments, position by position (rows) for all of them (columns)."""
        width, u = raw.shape
        longest = min(self.longest, width)
        total = np.zeros((width + 1, u), np.uint64)
        np.cumsum(C._byte_codes()[raw] * C._power_table(C._BASE, width)[:, None], axis=0, out=total[1:])
        back = C._power_table(C._BASE_INV, width)[:, None]
        at = np.arange(width)[:, None]
        head = (at < size) & ((raw & 0xC0) != 0x80)
        char = np.where(raw < 0x80, 1, np.where(raw < 0xE0, 2, np.where(raw < 0xF0, 3, 4)))
        step = np.minimum(char, np.maximum(size - at, 1))
        # edge[k - 1][i]: piece of k bytes from position i; -1 none, -2 unknown character
        edge, value = [], []
        single = np.zeros((width, u), bool)
        for k in range(1, longest + 1):
            w = width - k + 1
            where = np.flatnonzero(head[:w] & (at[:w] + k <= size))
            part = (total[k:] - total[:-k]) * back[:w] + np.uint64(k)
            found = np.full(w * u, -1, np.int32)
            found[where] = self.find(C.mix64(part.ravel()[where]))
            found = found.reshape(w, u)
            if k <= 4:
                single[:w] |= (found >= 0) & (char[:w] == k)
            edge.append(found)
        for k in range(1, longest + 1):
            found = edge[k - 1]
            if k <= 4:
                w = width - k + 1
                found[head[:w] & ~single[:w] & (step[:w] == k)] = -2
            value.append(self.edge_score[found])
        ahead = np.full((width + 1, u), NONE)
        ahead[0] = 0
        from_ = np.zeros((width + 1, u), np.int8)
        for j in range(1, width + 1):
            best, step_back = ahead[j], from_[j]
            for k in range(1, min(longest, j) + 1):
                s = ahead[j - k] + value[k - 1][j - k]
                step_back[s > best] = k
                np.maximum(best, s, out=best)
        cols = np.arange(u)
        score = ahead[size, cols]
        after = np.full((width + 1, u), NONE)
        after[size, cols] = 0
        for i in range(width - 1, -1, -1):
            for k in range(1, min(longest, width - i) + 1):
                np.maximum(after[i], value[k - 1][i] + after[i + k], out=after[i])
        # walk the best paths; their edges do not count for the second best
        pos, live, taken = size.copy(), cols[size > 0], np.zeros((width, u), np.int8)
        while len(live):
            k = from_[pos[live], live]
            pos[live] -= k
            taken[pos[live], live] = k
            live = live[pos[live] > 0]
        second = np.full(u, NONE)
        for k in range(1, longest + 1):
            w = width - k + 1
            through = ahead[:w] + value[k - 1] + after[k:]
            through[taken[:w] == k] = NONE
            np.maximum(second, through.max(axis=0), out=second)
        loss = np.where(second > NONE / 2, score - second, np.inf)
        # ids along the paths, in order
        c, i = np.nonzero(taken.T)
        k = taken[i, c].astype(np.int64)
        piece = np.empty(len(c), np.int64)
        for length in np.unique(k):
            m = k == length
            piece[m] = edge[length - 1][i[m], c[m]]
        out_size = np.where(piece >= 0, 1, k)
        begin = np.concatenate([[0], np.cumsum(out_size)])
        flat = np.empty(begin[-1], np.int32)
        known = piece >= 0
        flat[begin[:-1][known]] = self.key_id[piece[known]]
        for x in np.flatnonzero(~known):
            flat[begin[x]: begin[x + 1]] = self.byte_ids[raw[i[x]: i[x] + k[x], c[x]]]
        ends = begin[np.searchsorted(c, cols, side="right")]
        return flat, np.diff(ends, prepend=0), score, loss


def _char_size(first: int) -> int:
    return 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


def _hash_one(piece: bytes) -> np.uint64:
    raw = np.frombuffer(piece, np.uint8)
    total = (C._byte_codes()[raw] * C._power_table(C._BASE, len(raw))).sum() + np.uint64(len(raw))
    return C.mix64(np.array([total], np.uint64))[0]


@lru_cache(maxsize=4)
def load(proto: bytes, penalty: float) -> Pieces:
    return Pieces(proto, penalty)


def segment_bounds(pieces: Pieces, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of the segments of texts that each begin with the added space."""
    start = np.zeros(len(raw), bool)
    start[off[:-1][np.diff(off) > 0]] = True
    if pieces.splits:
        space = raw == 32
        start[1:] |= space[1:] & ~space[:-1]
    if pieces.lone:
        lone = raw == pieces.lone[0]
        start |= lone
        start[1:] |= lone[:-1]
    return np.flatnonzero(start)


def _encode_slice(pieces: Pieces, raw: np.ndarray, off: np.ndarray, nbest: int, cache: dict):
    """Per text: ids, best score, and the next segmentations as (loss, edits)."""
    n = len(off) - 1
    body = np.insert(raw, off[:-1], 32)                   # the added space
    off = off + np.arange(n + 1)
    empty = np.diff(off) == 1                             # an empty text has no piece
    start = segment_bounds(pieces, body, off)
    end = np.append(start[1:], len(body))
    key = np.empty(len(start), np.uint64)
    a = 0
    while a < len(start):                                 # hashes of the segments, in windows
        b = max(a + 1, int(np.searchsorted(end, start[a] + C.WINDOW_BYTES, side="right")))
        lo, hi = start[a], end[b - 1]
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(C._byte_codes()[body[lo:hi]] * C._power_table(C._BASE, hi - lo), out=total[1:])
        part = (total[end[a:b] - lo] - total[start[a:b] - lo]) * C._power_table(C._BASE_INV, hi - lo)[start[a:b] - lo]
        key[a:b] = C.mix64(part + (end[a:b] - start[a:b]).astype(np.uint64))
        a = b
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    seg_start, seg_size = start[first], end[first] - start[first]
    flat, begin, size, score, loss = pieces.solve(body, seg_start, seg_size)
    ptr = np.searchsorted(start, off)
    lens = size[which]
    lens[ptr[:-1][empty]] = 0
    out_off = np.concatenate([[0], np.cumsum(lens)])
    src = np.repeat(begin[which] - out_off[:-1], lens) + np.arange(out_off[-1])
    out = flat[src]
    text_ptr = out_off[ptr]
    sums = np.concatenate([[0.0], np.cumsum(score[which])])
    best = np.where(empty, 0.0, sums[ptr[1:]] - sums[ptr[:-1]])
    others = []
    losses = loss[which]
    for t in range(n):
        x, y = ptr[t], ptr[t + 1]
        if empty[t] or nbest < 2:
            others.append([])
            continue
        part = losses[x:y]
        m = min(nbest - 1, y - x)
        pick = np.argpartition(part, m - 1)[:m] if m < y - x else np.arange(y - x)
        limit = part[pick].max()
        pick = np.concatenate([np.flatnonzero(part < limit), np.flatnonzero(part == limit)])[:m]
        paths: list[tuple[float, list]] = [(0.0, [])]
        for k in sorted(pick.tolist(), key=lambda k: (part[k], k)):
            if not np.isfinite(part[k]):
                continue
            s = which[x + k]
            seg = body[seg_start[s]: seg_start[s] + seg_size[s]].tobytes()
            found = cache.get(seg)
            if found is None:
                if len(cache) > 20_000:
                    cache.clear()
                kept = flat[begin[s]: begin[s] + size[s]].tolist()
                found = pieces.nbest(seg, nbest)
                top = found[0][0]
                found = [(top - s, p) for s, p in found if p != kept][: nbest - 1]
                if len(seg) <= 256:
                    cache[seg] = found
            at = int(out_off[x + k] - text_ptr[t])
            options = [(0.0, None)] + [(d, (at, int(lens[x + k]), p)) for d, p in found]
            both = [(d + e, edits if change is None else [*edits, change]) for d, edits in paths for e, change in options]
            paths = sorted(both, key=lambda z: z[0])[:nbest]
        others.append([(d, sorted(edits, key=lambda z: z[0])) for d, edits in paths if edits][: nbest - 1])
    return out, text_ptr, best, others


ENCODED = ("ids array<int>, score double, "
           "others array<struct<score: double, edits: array<struct<at: int, n: int, ids: array<int>>>>>")


def _encode(proto: bytes, p: PieceParams, verify: bool):
    kind = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(pa.struct(
        [("at", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int32()))])))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(proto, p.penalty)
        cache: dict = {}
        for batch in batches:
            raw, off = C.text_buffers(batch.column("text"))
            for a, b in C.slices(off, SLICE_BYTES):
                ids, ptr, best, others = _encode_slice(pieces, raw[off[a]: off[b]], off[a: b + 1] - off[a], p.nbest, cache)
                rows = [[{"score": float(best[t] - d), "edits": [{"at": x, "n": n, "ids": i} for x, n, i in e]} for d, e in o]
                        for t, o in enumerate(others)]
                columns = [*(batch.column(c).slice(a, b - a) for c in batch.schema.names if c != "text"),
                           pa.ListArray.from_arrays(pa.array(ptr.astype(np.int32)), pa.array(ids)), pa.array(best), pa.array(rows, kind)]
                names = [c for c in batch.schema.names if c != "text"] + ["ids", "score", "others"]
                if verify:
                    same = [x == raw[i:j].tobytes() for x, i, j in zip(_decoded(pieces, ids, ptr), off[a:b], off[a + 1: b + 1])]
                    columns, names = [*columns, pa.array(same, pa.bool_())], [*names, "same"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _decoded(pieces, ids: np.ndarray, ptr: np.ndarray) -> list[bytes]:
    """UTF-8 of each list of ids, without the space that encoding puts before a text."""
    size = pieces.length[ids]
    to = np.concatenate([[0], np.cumsum(size)])
    data = pieces.buffer[np.repeat(pieces.begin[ids] - to[:-1], size) + np.arange(to[-1])].tobytes()
    ends = to[ptr]
    return [data[x + 1: y] for x, y in zip(ends[:-1], ends[1:])]


def _decode(proto: bytes, p: PieceParams):
    def decode(column: pa.Array) -> pa.Array:
        pieces = load(proto, p.penalty)
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        off, values = np.asarray(column.offsets), column.values
        parts = [pa.array([], pa.string())]
        for a, b in C.slices(off, SLICE_IDS):             # some rows at a time, a long one alone
            ids = np.asarray(values.slice(off[a], off[b] - off[a]))
            parts.append(pa.array([x.decode("utf-8", "replace") for x in _decoded(pieces, ids, off[a: b + 1] - off[a])], pa.string()))
        return pa.concat_arrays(parts)

    return decode


def _proto(params: PieceParams) -> bytes:
    with open(params.model, "rb") as f:                   # shipped to the executors with the function
        return f.read()


def encode(docs: DataFrame, params: PieceParams | None = None, columns: list[str] | None = None, verify: bool = False) -> DataFrame:
    """Columns ``columns`` of ``docs`` (all by default, in a struct ``row``) with ids, score
    and others: the best segmentation of ``text``, its score, and the next best ones, each
    as its score and the edits (replace n ids from ``at`` by ids) that turn the best one
    into it. Fewer others are given where a text has fewer segmentations. Null and empty
    texts have no ids and score 0. Equal texts get equal results; rows are never merged.
    Texts of any length are encoded whole, some at a time. With ``verify`` each text's ids
    are decoded again in the same task, and ``same`` says whether that gives the text."""
    p = params or PieceParams()
    cols = docs.columns if columns is None else columns
    slim = docs.select(F.struct(*[docs[f"`{c}`"] for c in cols]).alias("row"), docs["text"])
    return slim.mapInArrow(_encode(_proto(p), p, verify), C.row_schema(slim, ENCODED + (", same boolean" if verify else "")))


def decode(ids: Column, params: PieceParams | None = None) -> Column:
    """Text of an array of ids (null and empty arrays: '')."""
    p = params or PieceParams()
    run = _decode(_proto(p), p)

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        return run(column)

    return text(F.coalesce(ids, F.array().cast("array<int>")))
