"""Quality rules with adaptive thresholds, in column expressions only.

Each rule looks at one whole-number measure of a text. Its threshold is not fixed: it is
read from a quantile sketch of that measure among the texts of the same language and source.
The sketch is a histogram over logarithmic bins (values under 64 exactly, above that 32 bins
per doubling, so a quantile is right within about 3%). Sketches are plain counts: partial ones
merge by adding, in any order, with the same result; a small group's sketch is replaced by
its language's or by that of all texts, which are sums of the same bins.

Junk must not set its own limit. So a limit is also bounded by a multiple of the spread in
the clean half of the sketch (quartile to median, on the side away from the limit, which junk
does not reach before it is half of the group), in the group and in its language.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabline.llm import common as C
from cabline.session import materialize

#: Characters that count as symbols (fixed by the rules).
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
BREAK = r"[\x20\x09-\x0D]+"

#: Measures of the adaptive rules: a text far above (or below) what is usual is rejected.
HIGH = ("symbol_share", "dup_line_share", "repeat_share", "word_length")
LOW = ("word_length",)
WHOLE = 10_000                             # a share of everything


@dataclass(frozen=True)
class QualityParams:
    """min_words, max_repeat_percent: base rules. middle, tail: quantiles (in percent) of a
    measure; a text is rejected beyond tail + spread * (tail - middle) + margin of the
    measure, mirrored for the low side. min_group: texts that a group's own sketch needs.
    bound: a limit is at most middle + bound * (spread * (middle - quartile) + margin), and a
    share's at most half way from the middle to the whole."""

    min_words: int = 50
    max_repeat_percent: int = 50
    middle: int = 50
    tail: int = 90
    spread: int = 3
    margins: tuple[tuple[str, int], ...] = (("symbol_share", 100), ("dup_line_share", 3000), ("repeat_share", 1500), ("word_length", 500))
    min_group: int = 200
    quartile: int = 25
    bound: int = 4
    salts: int = 16


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds word and line counts of the whole column ``text`` (null: none) to ``docs``:
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (with a word)."""
    t = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(t, F.lit(BLANKS))
    words = F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, BREAK))
    filled = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
    df = docs.withColumn("_words", words).withColumn("_lines", filled)
    df = df.withColumn("n_words", F.size("_words").cast("long")).withColumn("n_lines", F.size("_lines").cast("long"))
    df = df.withColumn("n_dup_lines", F.col("n_lines") - F.size(F.array_distinct("_lines")))
    df = df.withColumn("word_chars", F.length(F.translate(t, BLANKS, "")).cast("long"))
    df = df.withColumn("n_symbols", (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"))
    # 3-word windows by hash; sorting brings equal ones together, their places mark words
    window = F.transform(
        F.sequence(F.lit(0), F.size("_words") - 3),
        lambda i: F.struct(F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("i")))
    df = df.withColumn("_sorted", F.when(F.size("_words") >= 3, F.sort_array(window)))
    twice = F.filter("_sorted", lambda w, k: (w["h"] == F.get("_sorted", k - 1)["h"]) | (w["h"] == F.get("_sorted", k + 1)["h"]))
    df = df.withColumn("_places", F.sort_array(F.transform(twice, lambda w: w["i"])))
    # a window covers three words; from the last covered one on, only new words count
    covered = F.aggregate(
        "_places", F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"])
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    return df.drop("_words", "_lines", "_sorted", "_places")


def shares() -> dict[str, Column]:
    """The measures as whole numbers, per ten thousand (word length: per thousand)."""
    per = lambda a, b, k: F.when(F.col(b) > 0, F.floor(F.col(a) * k / F.col(b))).otherwise(F.lit(0)).cast("long")
    return {
        "symbol_share": per("n_symbols", "word_chars", 10_000),
        "dup_line_share": per("n_dup_lines", "n_lines", 10_000),
        "repeat_share": per("n_repeat_words", "n_words", 10_000),
        "word_length": per("word_chars", "n_words", 1_000),
    }


def sketch_bin(v: Column) -> Column:
    """Bin of a value >= 0: itself under 64, then 32 bins per doubling, with whole numbers."""
    bits = F.length(F.bin(v)) - 6
    return F.when(v < 64, v).otherwise(bits * 32 + F.floor(v / F.pow(F.lit(2.0), bits)).cast("long"))


def bin_top(b: Column) -> Column:
    """Largest value of a bin."""
    bits = F.floor((b - 32) / 32)
    return F.when(b < 64, b).otherwise(((b - bits * 32 + 1) * F.pow(F.lit(2.0), bits) - 1).cast("long"))


def thresholds(measured: DataFrame, p: QualityParams) -> DataFrame:
    """Low and high limits per (lang, source), one row each, null groups included."""
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("v")) for k, v in shares().items()]))
    # combined per bin before any shuffle: a group of any size sends a few hundred rows
    bins = (
        measured.where("n_words >= %d" % p.min_words).select("lang", "source", values.alias("x"))
        .groupBy("lang", "source", F.col("x.rule").alias("rule"), sketch_bin(F.col("x.v")).alias("bin")).agg(F.count("*").alias("n")))
    # the same sketch for a language and for all texts: sums of the bins
    level = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("level")
    wide = bins.select("*", level).groupBy(
        "level", F.when(F.col("level") < 2, F.col("lang")).alias("lang"), F.when(F.col("level") < 1, F.col("source")).alias("source"),
        "rule", "bin").agg(F.sum("n").alias("n"))
    group = ["level", "lang", "source", "rule"]
    run = Window.partitionBy(*group).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*group)
    ranked = wide.withColumn("upto", F.sum("n").over(run)).withColumn("total", F.sum("n").over(whole))
    # the quantile q lies in the first bin that reaches q percent of the group
    reach = lambda q: F.min(F.when(F.col("upto") * 100 >= F.col("total") * q, bin_top(F.col("bin"))))
    q = ranked.groupBy(*group).agg(
        F.first("total").alias("total"), reach(p.middle).alias("mid"), reach(p.tail).alias("top"), reach(100 - p.tail).alias("low"),
        reach(p.quartile).alias("lower"), reach(100 - p.quartile).alias("upper"))
    margin = F.create_map(*[F.lit(x) for pair in p.margins for x in pair])[F.col("rule")]
    q = q.withColumn("high_bound", F.col("mid") + p.bound * (p.spread * (F.col("mid") - F.col("lower")) + margin))
    half = F.floor((F.col("mid") + WHOLE) / 2)
    q = q.withColumn("high_bound", F.when(F.col("rule").endswith("_share"), F.least("high_bound", half)).otherwise(F.col("high_bound")))
    q = q.withColumn("low_bound", F.col("mid") - p.bound * (p.spread * (F.col("upper") - F.col("mid")) + margin))
    q = q.withColumn("high_limit", F.least("high_bound", F.col("top") + p.spread * (F.col("top") - F.col("mid")) + margin))
    q = q.withColumn("low_limit", F.greatest("low_bound", F.col("low") - p.spread * (F.col("mid") - F.col("low")) - margin))
    names = [f"{k}_high" for k in HIGH] + [f"{k}_low" for k in LOW]
    picks = [F.struct(*[F.max(F.when(F.col("rule") == n.rpartition("_")[0], F.col(f"{n.rpartition('_')[2]}_{kind}"))).alias(n) for n in names]).alias(kind)
             for kind in ("limit", "bound")]
    limits = q.groupBy("level", "lang", "source").agg(F.max("total").alias("total"), *picks)
    own = limits.where("level = 0").select("lang", "source", "total", "limit")
    lang = limits.where("level = 1").select(
        F.col("lang").alias("l"), F.col("total").alias("l_total"), F.col("limit").alias("l_limit"), F.col("bound").alias("l_bound"))
    every = limits.where("level = 2").select(F.col("limit").alias("a_limit"), F.col("bound").alias("a_bound"))
    # one row of all texts, joined on a constant key
    out = own.join(lang, F.col("lang").eqNullSafe(F.col("l")), "left").withColumn("one", F.lit(1)).join(
        every.withColumn("one", F.lit(1)), "one", "left")
    chosen = F.when(F.col("total") >= p.min_group, F.col("limit")).when(F.col("l_total") >= p.min_group, F.col("l_limit")).otherwise(F.col("a_limit"))
    # a source that is mostly junk meets the bound of its language
    bound = F.when(F.col("l_total") >= p.min_group, F.col("l_bound")).otherwise(F.col("a_bound"))
    out = out.select("lang", "source", chosen.alias("limit"), bound.alias("bound"))
    stricter = [(F.least if n.endswith("_high") else F.greatest)(f"limit.{n}", f"bound.{n}").alias(n) for n in names]
    return out.select("lang", "source", *stricter)


def judge(measured: DataFrame, p: QualityParams | None = None) -> DataFrame:
    """Adds base_failed, failed_rules (names) and kept to the result of ``measure``.

    ``measured`` is read twice (sketches, then verdicts), so it should be a stored table:
    filters on an expression tree that counts words would be pushed below the counts and
    count anew. The limits are stored as well: a few rows whose size the planner knows, so that texts are not shuffled to
    meet them unless there are very many groups. Null languages and sources are groups of their own; a text without words fails the base
    rules; equal rows get equal verdicts; an empty table gives an empty result.
    """
    p = p or QualityParams()
    base = (F.col("n_words") < p.min_words) | (100 * F.col("n_repeat_words") > p.max_repeat_percent * F.col("n_words"))
    limits = materialize(thresholds(measured, p), "quality-limits").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(p.salts - 1))))
    limits = limits.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), F.col("salt").alias("_salt"),
                           *[c for c in limits.columns if c not in ("lang", "source", "salt")])
    # a hot group is spread over `salts` keys of the join
    rows = measured.withColumn("_k", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in ("n_words", "word_chars", "n_lines", "n_symbols")]), F.lit(p.salts)).cast("int"))
    for name, column in shares().items():
        rows = rows.withColumn(f"_{name}", column)
    match = F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("_k") == F.col("_salt"))
    out = rows.join(limits, match, "left")
    hits = [F.when(F.col(f"_{k}") > F.col(f"{k}_high"), F.lit(f"high {k}")) for k in HIGH]
    hits += [F.when(F.col(f"_{k}") < F.col(f"{k}_low"), F.lit(f"low {k}")) for k in LOW]
    out = out.withColumn("base_failed", base).withColumn("failed_rules", F.array_compact(F.array(*hits)))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    return out.select(*measured.columns, "base_failed", "failed_rules", "kept")


def quality(docs: DataFrame, columns: list[str], p: QualityParams | None = None) -> DataFrame:
    """Verdicts for ``docs`` (columns text, lang, source): struct ``row`` of ``columns`` with
    the measures, base_failed, failed_rules and kept. Extra columns never clash, and texts of
    any length are counted whole. The measures are stored beside ``row`` between the two readings, in the shared folder."""
    slim = docs.select(F.struct(*[docs[f"`{c}`"] for c in columns]).alias("row"), "text", "lang", "source")
    return judge(materialize(measure(slim).drop("text"), "quality-measures"), p)


def drop_low_quality(docs: DataFrame, p: QualityParams | None = None) -> DataFrame:
    """``docs`` without the texts that a rule rejects."""
    out = quality(docs, docs.columns, p).where("kept")
    return out.select(*C.unkeyed(out, docs.columns))
