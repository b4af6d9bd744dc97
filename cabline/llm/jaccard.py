"""N-gram Jaccard join: a MinHash LSH forest, then exact verification.

Every text is the set of its 5-word shingles (fewer words: one shingle of all of them; no
word: no shingle, such texts link with nothing). Texts with equal sets form one class, so
exact copies are never compared. A class's MinHash values are its label, a path of ``label``
hashes, in each of ``trees`` prefix tries.

No class ever needs a shorter prefix than the longest at which all tries together reach the
target recall at the threshold, so classes travel to the trie nodes of that depth. There
they are sorted by the rest of their labels, and matching starts with the longest prefixes:
at each depth a class is compared by signature with those that share so much of its path
and were not met deeper. What it has found tells how much it may have missed: a link of
similarity s is met at depth d with probability 1 - (1 - s^d)^trees, so the links found so
far, and one more at the threshold that might exist, give an estimate of its recall. A class
that reaches the target rests; the others go on with a prefix shorter by one hash. Members
of large groups thus rest at deep nodes, and few comparisons are made at crowded shallow
ones.

Signatures rule out pairs far below the threshold, and what remains is reduced to groups.
All pairs of a group are compared exactly on their shingles, in square tiles, so that a
group of any size spreads over tasks and only counts and a spanning set of links leave a
tile.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.llm import common as C
from cabline.session import drop_path, materialize_at


@dataclass(frozen=True)
class JaccardParams:
    """threshold: Jaccard similarity of a link. shingle: words of a shingle. trees, label:
    tries (256 at most) and hashes of a full label. recall: share of its links that a class
    must be estimated to have met before it rests. slack: a bucket's pair is compared when its signatures agree on more
    than threshold - slack of the hashes (more than seven standard deviations at the
    threshold). tile: classes on a side of a verification tile. tile_shingles: their
    shingles at most, on average."""

    threshold: float = 0.8
    shingle: int = 5
    trees: int = 32
    label: int = 8
    recall: float = 0.9999
    slack: float = 0.25
    tile: int = 256
    tile_shingles: int = 400_000

    def met(self, similarity, depth: int):
        """Probability that a pair shares a prefix of ``depth`` hashes in some trie."""
        return 1 - (1 - similarity**depth) ** self.trees

    def prefix(self) -> int:
        """The shortest prefix that any class needs: the longest at which the tries reach
        the recall at the threshold."""
        for depth in range(self.label, 0, -1):
            if self.met(self.threshold, depth) >= self.recall:
                return depth
        return 1


def min_hashes(shingles: np.ndarray, multipliers: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over a set, in blocks that stay in the cache."""
    best = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 256):
        part = multipliers[:, None] * shingles[None, i: i + 256]
        part += shifts[:, None]
        np.minimum(best, part.min(axis=1), out=best)
    return best


def _text_sets(column, width: int):
    """(row, sorted distinct shingles) of every row of a text column."""
    raw, off = C.text_buffers(column)
    for a, b in C.slices(off):
        _, _, h, ptr = C.tokens(raw[off[a]: off[b]], off[a: b + 1] - off[a])
        runs, rptr = C.window_hashes(h, ptr, width)
        for r in range(b - a):
            yield a + r, np.unique(runs[rptr[r]: rptr[r + 1]])


def signatures(p: JaccardParams):
    rng = np.random.default_rng(7)
    n = p.trees * p.label
    mult = rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)
    shift = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    depth = p.prefix()
    weigh = C.mix64(np.arange(1, p.label + 1, dtype=np.uint64)) | np.uint64(1)
    tree = C.mix64(np.arange(1, p.trees + 1, dtype=np.uint64))

    def run(batches):
        for batch in batches:
            n_sh, low, high, keys, sig = [], [], [], [], []
            for _, s in _text_sets(batch.column("text"), p.shingle):
                n_sh.append(len(s))
                if not len(s):
                    low.append(0), high.append(0), keys.append(None), sig.append(None)
                    continue
                low.append(int(C.signed(C.mix64(s).sum(keepdims=True))[0]))
                high.append(int(C.signed(np.bitwise_xor.reduce(C.mix64(s + np.uint64(99)), keepdims=True))[0]))
                m = min_hashes(s, mult, shift).reshape(p.trees, p.label)
                path = C.mix64((m[:, :depth] * weigh[:depth]).sum(axis=1) ^ tree)
                keys.append(C.signed((path & ~np.uint64(0xFF)) | np.arange(p.trees, dtype=np.uint64)))   # the low byte names the trie
                sig.append((C.mix64(m) >> np.uint64(56)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), pa.array(n_sh, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                names=["rid", "n_sh", "low", "high", "keys", "sig"])

    return run


def node_links(p: JaccardParams, sig: np.ndarray, tree: int, floor: int):
    """Pairs of a trie node whose signatures agree on ``floor`` hashes or more, from the
    longest shared prefixes to the node's own: (order of the rows in the trie, left, right)
    with places in that order. A row that rests is compared no more by its own."""
    n, depth = len(sig), p.prefix()
    tail = sig[:, tree * p.label + depth: (tree + 1) * p.label]    # a byte of each hash beyond the node
    order = np.lexsort(tail.T[::-1]) if tail.shape[1] else np.arange(n)
    sig, tail = sig[order], tail[order]
    found, total, rests = np.zeros(n), np.zeros(n), np.zeros(n, bool)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    below = np.arange(n)                                           # groups of the depth before
    for d in range(p.label, depth - 1, -1):
        new = np.ones(n, bool)
        new[1:] = (tail[1:, : d - depth] != tail[:-1, : d - depth]).any(axis=1)
        first = np.flatnonzero(new)
        for a, b in zip(first, np.append(first[1:], n)):
            if below[a] == below[b - 1]:
                continue                                           # nobody new at this depth
            rows = a + np.flatnonzero(~rests[a:b])
            for i in range(0, len(rows), 64):
                r = rows[i: i + 64]
                same = np.zeros((len(r), b - a), np.int32)
                for c in range(0, sig.shape[1], 32):
                    same += (sig[r, None, c: c + 32] == sig[None, a:b, c: c + 32]).sum(axis=2, dtype=np.int32)
                x, y = np.nonzero((same >= floor) & (below[r][:, None] != below[None, a:b]))
                left.append(r[x]), right.append(a + y)
                found += np.bincount(r[x], minlength=n)
                total += np.bincount(r[x], 1 / p.met(same[x, y] / sig.shape[1], d), minlength=n)
        rests = found + p.met(p.threshold, d) >= p.recall * (total + 1)
        below = np.cumsum(new) - 1
    return order, np.concatenate(left), np.concatenate(right)


def _bucket_links(p: JaccardParams):
    """Rows sorted by (key, tile): links of every tile as (node, smallest node of its group)."""
    floor = int(np.floor((p.threshold - p.slack) * p.trees * p.label))

    def tile(ids, sig, tree):
        order, left, right = node_links(p, sig, tree, floor)
        root = C.local_roots(len(ids), order[left], order[right])
        at = np.flatnonzero(root != np.arange(len(ids)))
        return ids[at], ids[root[at]]

    def run(batches):
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            rest = t if rest is None else pa.concat_tables([rest, t])
            key = rest["key"].to_numpy()
            cut = np.flatnonzero(key != key[-1])
            if not len(cut):
                continue
            cut = cut[-1] + 1
            yield from groups(rest.slice(0, cut))
            rest = rest.slice(cut)
        if rest is not None and len(rest):
            yield from groups(rest)

    def groups(t):
        key, part = t["key"].to_numpy(), t["part"].to_numpy()
        ids = t["rid"].to_numpy()
        sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint8).reshape(len(ids), -1)
        first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (part[1:] != part[:-1])]))
        size = np.diff(np.append(first, len(ids)))
        out = []
        pair = first[size == 2]                # most buckets: one pair, all at once
        for i in range(0, len(pair), 65536):
            at = pair[i: i + 65536]
            near = at[(sig[at] == sig[at + 1]).sum(axis=1) >= floor]
            lo, hi = np.minimum(ids[near], ids[near + 1]), np.maximum(ids[near], ids[near + 1])
            out.append((hi, lo))
        for i, n in zip(first[size > 2], size[size > 2]):
            order = np.argsort(ids[i: i + n], kind="stable")
            out.append(tile(ids[i: i + n][order], sig[i: i + n][order], int(key[i]) & 0xFF))
        if out:
            a, b = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _tiles(df: DataFrame, group: list[str], blocks, spread) -> DataFrame:
    """Copy each row to the tiles (i, j), i <= j, of its block in its group."""
    block = F.pmod(spread, blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))
    df = df.withColumn("block", block).withColumn("other", other)
    return df.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")


def _verify(p: JaccardParams):
    """Exact links inside one tile: (rid, linked documents, root in the tile)."""

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table["rid"].to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        ids, block, weight = (table[c].to_numpy() for c in ("rid", "block", "weight"))
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        n = len(ids)
        sets = [s for _, s in _text_sets(table["text"], p.shingle)]
        size = np.array([len(s) for s in sets])
        row = np.repeat(np.arange(n), size)
        _, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count[col] > 1
        _, col = np.unique(col[shared], return_inverse=True)
        row = row[shared]
        both = np.zeros((n, n), np.float32)
        order = np.argsort(col, kind="stable")
        row, col = row[order], col[order]
        width = max(64, min(8192, (1 << 22) // max(n, 1)))
        for c in range(0, int(col[-1]) + 1 if len(col) else 0, width):
            x, y = np.searchsorted(col, [c, c + width])
            part = np.zeros((n, width), np.float32)
            part[row[x:y], col[x:y] - c] = 1
            both += part @ part.T
        either = size[:, None] + size[None, :] - both
        limit = Fraction(p.threshold).limit_denominator(10**6)   # whole numbers: no rounding at the threshold
        link = both.astype(np.int64) * limit.denominator >= limit.numerator * either.astype(np.int64)
        np.fill_diagonal(link, False)
        if i != j:
            link &= block[:, None] != block[None, :]
        links = (link * weight[None, :]).sum(axis=1).astype(np.int64)
        root = C.local_roots(n, *np.nonzero(link))
        keep = links > 0
        return pa.table({"rid": ids[keep], "links": links[keep], "root": ids[root[keep]]})

    return run


def jaccard_links(docs: DataFrame, params: JaccardParams | None = None, keep: list[str] | None = None) -> DataFrame:
    """Near-duplicate classes of the column ``text`` of ``docs``.

    Returns every row of ``docs`` (columns ``keep``, all by default) in a struct ``row``,
    with rid (a row number), n_links (other rows at or above the threshold, exact copies
    included) and class_rid (the smallest rid that links reach, itself included). Repeated
    rows are copies of each other; null, empty and blank texts link with nothing; texts of
    any length count with all their shingles; an empty table gives an empty result. Extra columns of any name are carried in ``row``.
    """
    p = params or JaccardParams()
    cols = docs.columns if keep is None else list(dict.fromkeys([*keep, "text"]))
    base, _ = C.keyed(docs.select(*[docs[f"`{c}`"] for c in cols]), "jaccard-docs")
    texts = base.select("rid", F.col("row")["text"].alias("text"))
    made, made_path = materialize_at(
        texts.mapInArrow(signatures(p), "rid long, n_sh long, low long, high long, keys array<long>, sig binary"),
        "jaccard-sig")

    # classes of equal shingle sets: the smallest row stands for all
    sets = made.where("n_sh > 0").groupBy("low", "high", "n_sh").agg(F.min("rid").alias("rep"), F.count("*").alias("weight"))
    rep, rep_path = materialize_at(sets, "jaccard-rep")
    heads = made.join(rep.select(F.col("rep").alias("rid"), "weight"), "rid")

    # buckets with more than one class; a large one becomes several tiles
    paths = heads.select("rid", F.explode("keys").alias("key"))
    crowded = paths.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met, met_path = materialize_at(paths.join(crowded, "key"), "jaccard-met")
    blocks = F.ceil(F.col("n") / (2 * p.tile))
    tiles = _tiles(met, ["key"], blocks, F.xxhash64("rid"))
    tiles = tiles.select("key", "rid", (F.col("i").cast("long") * 2**31 + F.col("j")).alias("part"))
    links = (
        tiles.join(made.select("rid", "sig"), "rid")
        .repartition("key", "part").sortWithinPartitions("key", "part")
        .select("key", "part", "rid", "sig")
        .mapInArrow(_bucket_links(p), "a long, b long"))
    groups, group_paths = C.components(links)

    # exact comparison inside the groups
    member = groups.join(heads.select(F.col("rid").alias("node"), "n_sh", "weight"), "node")
    total = member.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_sh").alias("total"))
    sized = member.join(total, "component").withColumn(
        "blocks", F.greatest(F.ceil(F.col("n") / p.tile), F.least(F.col("n"), F.ceil(F.col("total") / p.tile_shingles))))
    tiles = _tiles(sized.withColumnRenamed("node", "rid"), ["component"], F.col("blocks"), F.xxhash64("rid"))
    tiles = tiles.join(texts, "rid").select("component", "i", "j", "block", "rid", "weight", "text")
    found, found_path = materialize_at(
        tiles.groupBy("component", "i", "j").applyInArrow(_verify(p), "rid long, links long, root long"), "jaccard-links")
    final, final_paths = C.components(found.select(F.col("rid").alias("a"), F.col("root").alias("b")))
    near = found.groupBy("rid").agg(F.sum("links").alias("links"))

    # back to rows: a row's class is its representative's
    head = (
        rep.join(near.withColumnRenamed("rid", "rep"), "rep", "left")
        .join(final.select(F.col("node").alias("rep"), F.col("component").alias("root")), "rep", "left")
        .select("low", "high", "n_sh", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("root", "rep").alias("class_rid")))
    rows = made.select("rid", "low", "high", "n_sh").join(head, ["low", "high", "n_sh"], "left").select(
        "rid", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("class_rid", "rid").alias("class_rid"))
    rows, _ = materialize_at(rows, "jaccard-rows")
    for path in (met_path, found_path, rep_path, made_path, *group_paths, *final_paths):
        drop_path(docs.sparkSession, path)
    return base.join(rows, "rid")


def drop_near_copies(docs: DataFrame, params: JaccardParams | None = None) -> DataFrame:
    """``docs`` with one row of each class (the first row number): a row is dropped only
    when links lead from it to the row that stays."""
    out = jaccard_links(docs, params).where("rid = class_rid")
    return out.select(*C.unkeyed(out, docs.columns))
