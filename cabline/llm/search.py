"""Ranked lexical search: documents grouped by the mask of the terms they hold.

Every item (query) has a list of terms. A document's presence mask has one bit for each
distinct term of the item that the document holds. All documents with one mask share an
upper bound of their score: the sum of what their terms can give at most. So the documents
are grouped by mask with bitwise operations on the terms' posting lists, masks are taken by
descending bound, their documents scored exactly, and the search for an item ends safely as
soon as the next bound lies below the lowest score that is still listed.

1. One pass over all texts writes the postings of the items' terms (document, number of
   terms, term numbers, counts): texts are split once, whole.
2. Sums over that table: documents with terms, their terms, documents per term.
3. One pass over the postings lists the best of every task; lists merge in two ranked
   steps, so that no task sees more than a bounded number of lists of one item.

Items are the query set: they are read in blocks of bounded size, each against all rows.
Words are compared by 64-bit hashes (a wrong match has a chance of 5e-20 a word).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabline.llm import common as C
from cabline.session import materialize_at

#: Bytes that no term holds: all ASCII but digits and letters.
TERM_BREAKS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

#: Stands for a null key, behind all others.
_NO_KEY = (1 << 63) - 1

POSTINGS = "key bigint, n bigint, terms array<int>, counts array<bigint>"


@dataclass(frozen=True)
class SearchParams:
    """top: documents listed per item. item_bytes: text of the items that one block (and the
    driver) holds. lists: tasks whose lists the first merging step brings together.
    postings: postings that a task scores at a time."""

    top: int = 20
    item_bytes: int = 1 << 20
    lists: int = 256
    postings: int = 1 << 19


@dataclass(frozen=True)
class Block:
    """Items of one pass. vocabulary: sorted hashes of their terms. terms, repeats: for each
    item its distinct terms (places in the vocabulary) and how often each stands in it."""

    keys: list
    vocabulary: np.ndarray
    terms: list[np.ndarray]
    repeats: list[np.ndarray]


def item_blocks(items: DataFrame, key: str, text: str, limit: int) -> Iterator[Block]:
    """The items in blocks of about ``limit`` bytes of text (a longer item alone). Items
    without a term are left out, since nothing matches them."""
    keys, texts, size = [], [], 0
    for row in items.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).toLocalIterator():
        if texts and size + len(row["t"] or "") > limit:
            yield _block(keys, texts)
            keys, texts, size = [], [], 0
        keys.append(row["k"])
        texts.append(row["t"] or "")
        size += len(texts[-1])
    if texts:
        yield _block(keys, texts)


def _block(keys: list, texts: list[str]) -> Block:
    _, _, hashes, at = C.tokens(*C.text_buffers(pa.array(texts, pa.large_string())), TERM_BREAKS, lower=True)
    vocabulary, place = np.unique(hashes, return_inverse=True)
    own = [np.unique(place[at[i]: at[i + 1]], return_counts=True) for i in range(len(texts))]
    held = [i for i, (t, _) in enumerate(own) if len(t)]
    return Block([keys[i] for i in held], vocabulary, [own[i][0] for i in held], [own[i][1] for i in held])


def _postings(vocabulary: np.ndarray):
    """(key, text) to (key, n, terms, counts); documents without any term are left out."""

    def run(batches):
        for batch in batches:
            raw_all, off_all = C.text_buffers(batch.column("text"))
            for a, b in C.slices(off_all):
                off = off_all[a: b + 1]
                raw, off = raw_all[off[0]: off[-1]], off - off[0]
                _, _, hashes, at = C.tokens(raw, off, TERM_BREAKS, lower=True)
                place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                hit = np.flatnonzero(vocabulary[place] == hashes)
                row = np.searchsorted(at, hit, side="right") - 1
                pair, count = np.unique(row * len(vocabulary) + place[hit], return_counts=True)
                row, term = pair // len(vocabulary), pair % len(vocabulary)
                ends = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
                n = np.diff(at)
                out = pa.RecordBatch.from_arrays([
                    batch.column("key").slice(a, b - a), pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(count, pa.int64()))], names=["key", "n", "terms", "counts"])
                yield out.filter(pa.array(n > 0))

    return run


def _holders(size: int):
    """Documents of a task that hold each term, as (term, df)."""

    def run(batches):
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column("terms").flatten().to_numpy(zero_copy_only=False), minlength=size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(df[held], pa.int64())], names=["term", "df"])

    return run


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) in doubles."""
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1.0))).astype(np.int64)


def gains(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What one occurrence of a term in an item gives per unit of weight, in integers: tf
    saturates, and the more slowly the longer a document is against the average."""
    m = 100 - 25 + (25 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1_000 * tf + 12 * m)


def mask_groups(rows: list[np.ndarray], n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents grouped by presence mask. rows[j]: documents that hold the item's term j.

    Each term sets its bit in the masks of its documents (64 terms a word). Returns the
    distinct masks as a matrix of bits, the documents ordered by mask, and where each
    mask's documents begin; documents without a term are in no group."""
    words = np.zeros((n_rows, (len(rows) + 63) // 64), np.uint64)
    for j, held in enumerate(rows):
        words[held, j // 64] |= np.uint64(1 << (j % 64))
    found = np.flatnonzero(words.any(axis=1))
    keys = words[found]
    order = np.lexsort(keys.T) if keys.shape[1] > 1 else np.argsort(keys[:, 0], kind="stable")
    keys, found = keys[order], found[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    starts = np.append(np.flatnonzero(new), len(keys))
    bits = np.stack([(keys[new][:, j // 64] >> np.uint64(j % 64)) & np.uint64(1) for j in range(len(rows))], axis=1)
    return bits.astype(np.int64), found, starts


class Listed:
    """The best documents of one item in a task so far: (score, key), best first."""

    def __init__(self, top: int):
        self.top, self.score, self.key = top, np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def floor(self) -> int:
        """A document below this score cannot enter any more."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, key: np.ndarray) -> None:
        enters = score >= self.floor
        score, key = np.append(self.score, score[enters]), np.append(self.key, key[enters])
        best = np.lexsort([key, -score])[: self.top]
        self.score, self.key = score[best], key[best]


def _search_rows(block: Block, weights: np.ndarray, stats: tuple[int, int], batch, listed: list[Listed]) -> None:
    """Enters the documents of one slice of postings into the items' lists."""
    ends = np.concatenate([[0], np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))])
    keys, n_rows = batch.column("key").to_numpy(zero_copy_only=False), batch.num_rows
    row = np.repeat(np.arange(n_rows), np.diff(ends))
    term = batch.column("terms").flatten().to_numpy(zero_copy_only=False)
    tf = batch.column("counts").flatten().to_numpy(zero_copy_only=False)
    gain = gains(tf, batch.column("n").to_numpy(zero_copy_only=False)[row], *stats)
    order = np.argsort(term, kind="stable")
    at = np.searchsorted(term[order], np.arange(len(block.vocabulary) + 1))
    held, filled = row[order], np.flatnonzero(np.diff(at))
    most = np.zeros(len(block.vocabulary), np.int64)
    most[filled] = np.maximum.reduceat(gain[order], at[filled]) if len(filled) else 0
    for terms, repeats, best in zip(block.terms, block.repeats, listed):
        worth = np.zeros(len(block.vocabulary), np.int64)
        worth[terms] = repeats * weights[terms]
        here = terms[(at[terms + 1] > at[terms]) & (worth[terms] > 0)]
        top = worth[here] * most[here]
        if not len(here) or int(top.sum()) < best.floor:
            continue
        bits, found, starts = mask_groups([held[at[t]: at[t + 1]] for t in here], n_rows)
        bound = bits @ top
        ranked = np.argsort(-bound, kind="stable")
        i = 0
        while i < len(ranked) and bound[ranked[i]] >= best.floor:
            docs, size = [], 0                      # some groups at a time, the highest bounds first
            while i < len(ranked) and size < 4 * best.top and bound[ranked[i]] >= best.floor:
                docs.append(found[starts[ranked[i]]: starts[ranked[i] + 1]])
                size += len(docs[-1])
                i += 1
            docs = np.concatenate(docs)
            length = ends[docs + 1] - ends[docs]
            first = np.cumsum(length) - length
            place = np.repeat(ends[docs] - first, length) + np.arange(length.sum())
            best.add(np.add.reduceat(worth[term[place]] * gain[place], first), keys[docs])


def _search(block: Block, weights: np.ndarray, stats: tuple[int, int], p: SearchParams):
    from pyspark import TaskContext

    def run(batches):
        listed = [Listed(p.top) for _ in block.keys]
        for batch in batches:
            ends = np.concatenate([[0], np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))])
            for a, b in C.slices(ends, p.postings):
                _search_rows(block, weights, stats, batch.slice(a, b - a), listed)
        sizes = [len(x.key) for x in listed]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int32()),
                pa.array(np.full(sum(sizes), TaskContext.get().partitionId() // p.lists), pa.int32()),
                pa.array(np.concatenate([x.key for x in listed])),
                pa.array(np.concatenate([x.score for x in listed]))], names=["item", "part", "key", "score"])

    return run


def ranked_search(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id",
                  text: str = "text", params: SearchParams | None = None) -> DataFrame:
    """For each item its ``top`` documents with score above 0: (item, rank, doc, score), rank
    from 1, equal scores by ascending key.

    Reads the integer key and the text of both tables; other columns are not looked at. A
    null or empty text has no terms, so it neither matches nor counts as a document. Texts
    of any length are read whole. Each row is a document or an item of its own, also where
    keys repeat; a null document key stands behind all others (as the largest long, which
    no key may be). Items or documents without rows give an empty result.
    """
    p = params or SearchParams()
    spark = docs.sparkSession
    slim = docs.select(F.coalesce(F.col(f"`{doc_key}`").cast("long"), F.lit(_NO_KEY)).alias("key"), F.col(f"`{text}`").alias("text"))
    key_type = items.schema[item_key].dataType
    found = None
    for block in item_blocks(items, item_key, text, p.item_bytes):
        if not block.keys:
            continue
        postings, _ = materialize_at(slim.mapInArrow(_postings(block.vocabulary), POSTINGS), "postings")
        total = postings.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not total["docs"]:
            continue
        size = len(block.vocabulary)                 # bounded by the block's text
        counted = postings.select("terms").mapInArrow(_holders(size), "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
        df = np.zeros(size, np.int64)
        df[counted["term"].to_numpy()] = counted["df"].to_numpy()
        stats = total["docs"], total["terms"]
        best = postings.mapInArrow(_search(block, term_weights(stats[0], df), stats, p), "item int, part int, key bigint, score bigint")
        for by in (["item", "part"], ["item"]):
            rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "key"))
            best = best.withColumn("rank", rank).where(F.col("rank") <= p.top)
        names = spark.createDataFrame(list(enumerate(block.keys)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("name", key_type)]))
        best = best.join(F.broadcast(names), "item").select(
            F.col("name").alias("item"), "rank", F.nullif("key", F.lit(_NO_KEY)).alias("doc"), "score")
        found = best if found is None else found.unionByName(best)
    if found is None:
        empty = T.StructType([T.StructField("item", key_type), *T.StructType.fromDDL("rank int, doc bigint, score bigint").fields])
        return spark.createDataFrame([], empty)
    return found
