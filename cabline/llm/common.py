"""Helpers shared by the operators: row keys, Arrow text arithmetic, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabline.session import drop_path, materialize_at

#: Bytes that end a word: space and the ASCII controls tab to carriage return.
WORD_BREAKS = bytes([0x20, *range(0x09, 0x0E)])
#: Spark pattern of a word under the same rule.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one vectorised step handles; bounds the temporary arrays of a task.
WINDOW_BYTES = 1 << 20


def held_out(doc_id, remainder: int):
    """crc32 of the id as text, modulo 5, equals ``remainder`` (a null id counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == remainder


def keyed(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once as (rid, row): a row number that stays the same in every later
    read (ids of documents may repeat or be null) and all columns in one struct, whatever
    their names. Returns the table and its folder."""
    row = F.struct(*[df[f"`{c}`"] for c in df.columns]) if df.columns else F.struct(F.lit(0).alias("_"))
    return materialize_at(df.select(F.monotonically_increasing_id().alias("rid"), row.alias("row")), name)


def unkeyed(df: DataFrame, columns: list[str]) -> list:
    """The columns that ``keyed`` packed."""
    return [F.col("row").getField(c).alias(c) for c in columns]


def row_schema(df: DataFrame, ddl: str) -> T.StructType:
    """Schema of the struct ``row`` of ``df`` followed by the columns of a DDL string."""
    return T.StructType([df.schema["row"], *T.StructType.fromDDL(ddl).fields])


# --- Arrow text arithmetic ---------------------------------------------------------------


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=1)
def _byte_codes() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_BASE = np.uint64(0x9E3779B97F4A7C15)          # odd, hence invertible modulo 2**64
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, WINDOW_BYTES + 4096)
        table = np.full(size, base, dtype=np.uint64)
        table[0] = 1
        have = _powers[int(base)] = np.multiply.accumulate(table)
    return have[:n]


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows in them (a null row is empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0]: off[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, off - off[0]


def slices(offsets: np.ndarray, limit: int = WINDOW_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes (a longer row alone)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield a, min(b, n)
        a = b


def tokens(raw: np.ndarray, offsets: np.ndarray, breaks: bytes = WORD_BREAKS, lower: bool = False):
    """Tokens of every row, split at the bytes ``breaks`` (ASCII, so UTF-8 stays whole).

    Returns (starts, ends, hashes, pointers): byte spans, 64-bit hashes, and for row r its
    tokens pointers[r]:pointers[r+1]. Works through the bytes in windows cut at breaks or
    row ends, so temporaries stay small however long a row is.
    """
    is_word = np.ones(256, bool)
    is_word[list(breaks)] = False
    spans, n = [], len(raw)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    a = 0
    while a < n:
        b = min(n, a + WINDOW_BYTES)
        while b < n:                           # move the cut to a break or a row end
            step = raw[b: b + 4096]
            hit = np.flatnonzero(~is_word[step] | edge[b: b + len(step)])
            if len(hit):
                b += int(hit[0])
                break
            b += len(step)
        part = raw[a:b]
        if lower:
            part = np.where((part >= 65) & (part <= 90), part + 32, part).astype(np.uint8)
        word = is_word[part]
        first = word.copy()
        first[1:] &= ~word[:-1] | edge[a + 1: b]
        last = word.copy()
        last[:-1] &= ~word[1:] | edge[a + 1: b]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_byte_codes()[part] * _power_table(_BASE, len(part)), out=total[1:])
        h = mix64((total[e] - total[s]) * _power_table(_BASE_INV, len(part))[s] + (e - s).astype(np.uint64))
        spans.append((s + a, e + a, h))
        a = b
    if spans:
        starts, ends, hashes = (np.concatenate(x) for x in zip(*spans))
    else:
        starts, ends, hashes = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return starts, ends, hashes, np.searchsorted(starts, offsets, side="left")


def window_hashes(hashes: np.ndarray, pointers: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``width`` tokens inside a row, and row pointers into them. A
    row with fewer tokens has one run of all its tokens; one with none has no run."""
    counts = np.diff(pointers)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_ptr = np.concatenate([[0], np.cumsum(runs)])
    out = np.empty(out_ptr[-1], np.uint64)
    factors = mix64(np.arange(11, 11 + width, dtype=np.uint64)) | np.uint64(1)
    n = len(hashes)
    full = np.zeros(max(0, n - width + 1), np.uint64)
    for j in range(width):
        full += hashes[j: n - width + 1 + j] * factors[j] if len(full) else 0
    rows = np.repeat(np.arange(len(counts)), runs)
    at = np.arange(len(out)) - out_ptr[rows] + pointers[rows]
    whole = counts[rows] >= width
    out[whole] = mix64(full[at[whole]])
    for k in np.flatnonzero((counts > 0) & (counts < width)):
        h = hashes[pointers[k]: pointers[k + 1]]
        out[out_ptr[k]] = mix64(np.array([(h * factors[: len(h)]).sum() + np.uint64(len(h))], np.uint64))[0]
    return out, out_ptr


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# --- connected components ----------------------------------------------------------------


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of the component of each of n nodes under the edges (a, b), in one task."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def components(edges: DataFrame, a: str = "a", b: str = "b") -> tuple[DataFrame, list[str]]:
    """(node, component): the smallest node that each node of ``edges`` reaches.

    Alternates large-star and small-star steps; each step is a minimum per node (combined
    before the shuffle) joined back to the edges, written to the shared folder, until the
    edges are stars. No neighbour list is ever gathered, so a hub is only a hot join key,
    which adaptive execution splits. Returns the result and the folders it reads.
    """
    spark = edges.sparkSession
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    e, path = materialize_at(e, "cc")

    def star(edge: DataFrame, large: bool) -> DataFrame:
        both = edge.union(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not large:
            both = both.where("v < u")
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        out = both.join(low, "u")
        if large:
            return out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        links = out.select(F.col("v").alias("u"), F.col("m").alias("v"))
        return links.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()

    def state(edge: DataFrame):
        # every node hangs on one smaller node, and no such node hangs on another: stars
        return edge.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()

    before = state(e)
    while before["n"]:
        nxt, to = materialize_at(star(star(e, True), False), "cc")
        now = state(nxt)
        drop_path(spark, path)
        e, path = nxt, to
        if now == before:
            break
        before = now
    tails = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    heads = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return tails.unionByName(heads), [path]
