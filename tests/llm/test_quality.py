import random
from collections import Counter

from pyspark.sql import functions as F

from cabline.llm import quality as Q
from .conftest import words


def counts(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    grams = [tuple(w[i: i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_counts_of_the_table_and_of_awkward_rows(documents, awkward):
    for df in (documents, awkward):
        for r in Q.measure(df.select("text", "doc_id")).collect():
            assert tuple(r[n] for n in NAMES) == counts(r.text)


def test_sketch_bins(spark):
    values = [*range(0, 300), *[2**k + d for k in range(8, 40) for d in (-1, 0, 1)]]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", Q.sketch_bin(F.col("v")).alias("b")).select("*", Q.bin_top(F.col("b")).alias("t")).collect()
    rows.sort()
    for a, b in zip(rows, rows[1:]):
        assert a.b <= b.b and (a.b == b.b) == (b.v <= a.t)
    assert all(r.v <= r.t <= r.v * (1 + 1 / 32) + 1 for r in rows)


def corpus(seed=0):
    rng = random.Random(seed)
    vocab = [f"{a}{b}{c}" for a in "abcdefgh" for b in "iou" for c in "klmnpr"]
    rows = []
    for d in range(900):
        lines = [" ".join(rng.choice(vocab) for _ in range(20)) for _ in range(8)]
        if d % 30 == 3:
            lines = [x.replace(" ", " | #").replace("a", "$") for x in lines]
        if d % 30 == 7:
            lines = [lines[0]] * 8
        rows.append((d, "\n".join(lines), ["en", "de", None][d % 3], "hot" if d % 2 else f"s{d % 40}"))
    return rows


def test_junk_goes_and_clean_texts_stay(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in Q.drop_low_quality(docs).collect()}
    assert kept == {d for d, *_ in corpus() if d % 30 not in (3, 7)}


def test_thresholds_do_not_depend_on_partitions(spark):
    docs = spark.createDataFrame(corpus(1), "doc_id long, text string, lang string, source string")
    a, b = (sorted(map(str, Q.thresholds(Q.measure(docs.repartition(n)), Q.QualityParams()).collect())) for n in (1, 13))
    assert a == b


def test_awkward_rows_and_native_plan(awkward):
    out = Q.quality(awkward, awkward.columns)
    assert out.count() == awkward.count()
    plan = out._jdf.queryExecution().executedPlan().toString() + Q.measure(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    for r in out.collect():
        n, _, _, _, repeat = counts(r.row.text)
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n)
        assert not (r.base_failed and r.kept)
    assert Q.drop_low_quality(awkward).columns == awkward.columns
    assert Q.drop_low_quality(awkward.limit(0)).count() == 0


def dirty(share, alone):
    """600 texts of a hot source, ``share`` in ten of them junk of three kinds, and (unless
    alone) 600 clean ones of another source."""
    rng = random.Random(7)
    vocab = [f"{a}{b}{c}" for a in "abcdefgh" for b in "iou" for c in "klmnpr"]
    rows, junk = [], set()
    for d in range(600 if alone else 1200):
        lines = [" ".join(rng.choice(vocab) for _ in range(20)) for _ in range(8)]
        if d < 600 and d % 10 < share:
            junk.add(d)
            if d % 3 == 0:
                lines = [x.replace(" ", " | #").replace("a", "$") for x in lines]
            elif d % 3 == 1:
                lines = [x.replace(" ", "# #") for x in lines]
            else:
                lines = [x.replace(" ", f" {'w' * 30}#{i} ") for i, x in enumerate(lines)]
        rows.append((d, "\n".join(lines), "en", "hot" if d < 600 else "calm"))
    return rows, junk


def test_junk_does_not_set_its_own_limit(spark):
    """A source that is 30 % junk (alone in its language or not) or 60 % junk beside clean ones."""
    for share, alone in ((3, True), (3, False), (6, False)):
        if share == 6:
            rows, junk = dirty(share, alone)
            rows += [(2000 + d, t, lang, "calm") for d, t, lang, s in rows if s == "calm"]
        else:
            rows, junk = dirty(share, alone)
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        kept = {r.doc_id for r in Q.drop_low_quality(docs).collect()}
        assert kept == {r[0] for r in rows} - junk, (share, alone, len(kept & junk))


def test_sql_twin_follows_the_bound(spark):
    """The query's SQL on tables whose sources are partly junk gives the code's verdicts."""
    import duckdb

    from cabline.llm.queries import ORACLE
    for share, alone in ((3, True), (6, False), (0, False)):
        rows, _ = dirty(share, alone)
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        kept = {r.row.doc_id: r.kept for r in Q.quality(docs, ["doc_id"]).collect()}
        con = duckdb.connect()
        con.register("documents", docs.toArrow())
        assert dict(con.execute(f"SELECT doc_id, kept FROM ({ORACLE['op5_quality_rules']})").fetchall()) == kept
