"""Line dedup: winnowing over line hashes.

A text is the sequence of its lines that hold a word (a line's hash is that of its words).
A *gram* starts at a line and takes following lines until it has ``noise`` words. Within
every stretch of lines that has ``guarantee`` words the gram with the smallest hash is
selected. What is selected depends on the stretch alone, so two equal runs of lines with at
least ``guarantee`` words select the same gram at the same place: no such repeat is missed.
A selected gram carries one hash per extension over its neighbouring lines, ``guarantee``
words to each side; a run cannot reach further without a further selected gram.

The first place of every gram and of every extension is a minimum over all places. A place
that is not the first one is extended each way as far as any earlier place agrees with it,
and that run is deleted from its text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabline.llm import common as C
from cabline.session import drop_path, materialize_at


@dataclass(frozen=True)
class LineParams:
    """guarantee: repeats of so many words are found wherever they stand. noise: repeats
    under so many words are never deleted. order_by: column whose order says which place is
    earlier (nulls last, then the table's order)."""

    guarantee: int = 50
    noise: int = 25
    order_by: str = "doc_id"


def line_arrays(raw: np.ndarray, off: np.ndarray):
    """Lines with a word, for all rows: (hashes, word counts, row pointers)."""
    starts, _, words, ptr = C.tokens(raw, off)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(len(off), np.int64)
    breaks = np.flatnonzero(raw == 10)
    line = np.searchsorted(breaks, starts)
    new = np.empty(len(starts), bool)
    new[0] = True
    new[1:] = line[1:] != line[:-1]
    new[ptr[:-1][np.diff(ptr) > 0]] = True
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    place = np.arange(len(starts)) - np.repeat(first, count)
    weight = C.mix64(place.astype(np.uint64) + np.uint64(17)) | np.uint64(1)
    return C.mix64(np.add.reduceat(words * weight, first)), count, np.searchsorted(first, ptr)


def fingerprints(hashes: np.ndarray, words: np.ndarray, ptr: np.ndarray, noise: int, guarantee: int):
    """Selected grams: (row, first line, end line, gram hash, left neighbour, right
    neighbour); lines count within the arrays."""
    n = len(hashes)
    before = np.concatenate([[0], np.cumsum(words)])
    row = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    stop = ptr[1:][row]
    at = np.arange(n)
    end = np.searchsorted(before, before[:-1] + noise)
    reach = np.searchsorted(before, before[:-1] + guarantee)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(C.mix64(hashes) * C._power_table(C._BASE, n), out=total[1:])
    end_in = np.minimum(end, n)
    gram = C.mix64((total[end_in] - total[:-1]) * C._power_table(C._BASE_INV, n)) if n else hashes
    # smallest gram of each stretch, the last of equals
    whole = reach <= stop
    i = at[whole]
    last = np.searchsorted(end, reach[whole], side="right") - 1
    best = i.copy()
    step = 1
    while True:
        open_ = i + step <= last
        if not open_.any():
            break
        c = np.minimum(i + step, n - 1)
        take = open_ & (gram[c] <= gram[best])
        best = np.where(take, c, best)
        step += 1
    sel = np.unique(best)
    left = np.maximum(ptr[:-1][row[sel]], np.searchsorted(before, before[sel] - guarantee, side="right") - 1)
    left = np.minimum(np.maximum(left, ptr[:-1][row[sel]]), sel)
    right = np.minimum(stop[sel], np.searchsorted(before, before[end[sel]] + guarantee))
    return row[sel], sel, end[sel], gram[sel], left, right


def neighbourhoods(hashes: np.ndarray, sel: np.ndarray, end: np.ndarray, gram: np.ndarray, left: np.ndarray, right: np.ndarray):
    """One key for every extension of every gram, shortest first: hash of the gram, the side
    and the lines between. Returns (keys, row pointers) of the left and of the right side."""
    n = len(hashes)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(C.mix64(hashes) * C._power_table(C._BASE, n), out=total[1:])
    inverse = C._power_table(C._BASE_INV, n)
    out = []
    for side, size in ((1, sel - left), (2, right - end)):
        ptr = np.concatenate([[0], np.cumsum(size)])
        of = np.repeat(np.arange(len(sel)), size)
        length = np.arange(ptr[-1]) - ptr[of] + 1
        a = sel[of] - length if side == 1 else end[of]
        lines = (total[a + length] - total[a]) * inverse[a]
        out.append((C.mix64(C.mix64(lines + length.astype(np.uint64) * np.uint64(4) + np.uint64(side)) ^ C.mix64(gram[of] + np.uint64(side))), ptr))
    return out


def _select(p: LineParams):
    def run(batches):
        for batch in batches:
            raw, off = C.text_buffers(batch.column("text"))
            rid = batch.column("rid").to_numpy()
            for a, b in C.slices(off):
                h, w, ptr = line_arrays(raw[off[a]: off[b]], off[a: b + 1] - off[a])
                row, s, e, gram, left, right = fingerprints(h, w, ptr, p.noise, p.guarantee)
                if not len(row):
                    continue
                base = ptr[:-1][row]
                sides = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(C.signed(k))) for k, at in neighbourhoods(h, s, e, gram, left, right)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(C.signed(gram)), pa.array(rid[a + row]), pa.array((s - base).astype(np.int64)),
                     pa.array((e - s).astype(np.int32)), *sides],
                    names=["gram", "rid", "line", "n", "before", "after"])

    return run


def _cut(text: pd.Series, cuts: pd.Series) -> pd.DataFrame:
    """Texts without the lines in the cuts ([start, stop, start, stop, ...], counted over
    lines with a word), and the numbers of lines and words that went."""
    new, lines, words = [], [], []
    for t, cut in zip(text, cuts):
        if cut is None or t is None:
            new.append(t), lines.append(0), words.append(0)
            continue
        gone = set()
        for a, b in zip(cut[::2], cut[1::2]):
            gone.update(range(int(a), int(b)))
        kept, k, lost, lost_words = [], -1, 0, 0
        for line in t.split("\n"):
            w = len(line.encode().split())      # bytes split at the ASCII breaks only
            k += bool(w)
            if w and k in gone:
                lost, lost_words = lost + 1, lost_words + w
            else:
                kept.append(line)
        new.append("\n".join(kept)), lines.append(lost), words.append(lost_words)
    return pd.DataFrame({"text": new, "lines": lines, "words": words})


def line_dedup(docs: DataFrame, params: LineParams | None = None, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (struct ``row`` of the columns ``keep``, all by default) with ``new_text``,
    ``removed_lines`` and ``removed_words``: the text without later repeats.

    The first place of a repeat stays, also when both places are in one text. Null texts
    stay null and empty ones empty; repeated rows are repeats like any other (the first
    stays whole); texts of any length are compared whole; an empty table gives an empty
    result. Lines without a word are neither
    compared nor deleted. Extra columns of any name travel in ``row``.
    """
    p = params or LineParams()
    spark = docs.sparkSession
    order = [p.order_by] if p.order_by in docs.columns else []
    cols = docs.columns if keep is None else list(dict.fromkeys([*keep, *order, "text"]))
    base, _ = C.keyed(docs.select(*[docs[f"`{c}`"] for c in cols]), "lines-docs")
    schema = "gram long, rid long, line long, n int, before array<long>, after array<long>"
    marks, marks_path = materialize_at(base.select("rid", F.col("row")["text"].alias("text")).mapInArrow(_select(p), schema), "lines-marks")
    # only grams that stand in two places go on
    twice = marks.groupBy("gram").agg(F.count("*").alias("places")).where("places > 1").select("gram")
    seen = marks.join(twice, "gram")
    if order:
        who = base.select("rid", F.col("row")[p.order_by].alias("o"))
        seen = seen.join(who, "rid").select("*", F.col("o").isNull().alias("z"))
    else:
        seen = seen.select("*", F.lit(0).alias("o"), F.lit(False).alias("z"))
    seen, seen_path = materialize_at(seen, "lines-seen")
    place = F.struct("z", "o", "rid", "line")
    # keys of both sides; length 0 is the gram alone
    step = lambda sign: lambda k, i: F.struct(k.alias("key"), (sign * (i + 1)).alias("length"))
    sides = [F.transform("before", step(-1)), F.transform("after", step(1))]
    keys = F.explode(F.concat(F.array(F.struct(F.col("gram").alias("key"), F.lit(0).alias("length"))), *sides))
    keyed = seen.select(keys.alias("x"), place.alias("place"), "n").select("x.key", "x.length", "place", "n")
    # the first place of every key, combined before the shuffle; a key of one place has no other
    first = keyed.groupBy("key").agg(F.min("place").alias("first"), F.count("*").alias("places")).where("places > 1").drop("places")
    later = keyed.join(first, "key").where(F.col("place") > F.col("first"))
    # an extension that stands earlier has all shorter ones earlier as well
    cuts = later.groupBy(F.col("place.rid").alias("rid"), F.col("place.line").alias("line")).agg(
        F.min("length").alias("back"), F.max("length").alias("on"), F.first("n").alias("n"))
    cuts = cuts.select("rid", (F.col("line") + F.least("back", F.lit(0))).alias("start"), (F.col("line") + F.col("n") + F.greatest("on", F.lit(0))).alias("stop"))
    cuts = cuts.distinct().groupBy("rid").agg(F.flatten(F.collect_list(F.array("start", "stop"))).alias("cuts"))
    cuts, _ = materialize_at(cuts, "lines-cuts")
    drop_path(spark, marks_path)
    drop_path(spark, seen_path)
    cut = F.pandas_udf(_cut, T.StructType([T.StructField("text", T.StringType()), T.StructField("lines", T.LongType()), T.StructField("words", T.LongType())]))
    cut = cut.asNondeterministic()             # one call per text, wherever its results are used
    # one plan at every size: texts are dealt by row number, whether the cuts are few or many
    out = base.join(cuts.hint("merge"), "rid", "left").withColumn("new", cut(F.col("row")["text"], F.col("cuts")))
    return out.select("rid", "row", F.col("new.text").alias("new_text"), F.col("new.lines").alias("removed_lines"),
                      F.col("new.words").alias("removed_words"))


def drop_repeated_lines(docs: DataFrame, params: LineParams | None = None) -> DataFrame:
    """``docs`` with the shortened texts (and ``n_chars`` counted anew where it exists); a
    text that loses all its words to earlier places is a whole copy and goes."""
    out = line_dedup(docs, params)
    gone = (F.col("removed_lines") > 0) & ~F.coalesce(F.col("new_text").rlike(C.WORD), F.lit(False))
    out = out.where(~gone)
    cols = []
    for c in docs.columns:
        kept = F.col("row").getField(c)
        if c == "text":
            kept = F.col("new_text")
        elif c == "n_chars":
            kept = F.when(F.col("removed_lines") > 0, F.length("new_text").cast(docs.schema[c].dataType)).otherwise(kept)
        cols.append(kept.alias(c))
    return out.select(*cols)
