import random

from cabline.llm.lines import LineParams, drop_repeated_lines, line_dedup
from .conftest import words


def by_text(df):
    return {(r.doc_id, r.text): r for r in df.selectExpr("row.doc_id", "row.text", "new_text", "removed_lines", "removed_words").collect()}


def long_line(tag, n):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_repeated_passages_go_and_clean_texts_stay(spark):
    rng = random.Random(3)
    passage = [long_line("p", 20), long_line("q", 18), long_line("r", 22)]           # 60 words on three lines
    single = long_line("s", 55)                                                       # on one line
    short = long_line("t", 12)                                                        # frequent, but no passage
    docs = []
    for d in range(40):
        own = [long_line(f"d{d}l{k}n", rng.randint(3, 40)) for k in range(6)]
        if d % 4 == 1:
            own[2:2] = passage
        if d % 5 == 2:
            own.append(single)
        own.insert(1, short)
        docs.append((d, "\n".join(own)))
    out = by_text(line_dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)))
    for d, text in docs:
        lines = text.split("\n")
        want = [x for x in lines if not ((d % 4 == 1 and d != 1 and x in passage) or (d % 5 == 2 and d != 2 and x == single))]
        assert out[(d, text)].new_text == "\n".join(want), d
        assert out[(d, text)].removed_lines == len(lines) - len(want)


def test_every_repeat_over_the_guarantee_is_found(spark):
    """Any run of lines with 50 words or more that stands earlier is gone from later texts."""
    rng = random.Random(5)
    pool = [long_line(f"l{k}w", rng.randint(1, 30)) for k in range(60)]
    docs = []
    for d in range(60):
        a = rng.randrange(50)
        run = pool[a: a + rng.randint(1, 9)]
        docs.append((d, "\n".join([long_line(f"own{d}a", 9), *run, long_line(f"own{d}b", 9)])))
    p = LineParams()
    out = by_text(line_dedup(spark.createDataFrame(docs, "doc_id long, text string")))
    earlier = set()
    for d, text in docs:
        lines = text.split("\n")
        runs = [(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines) + 1)]
        must, may = set(), set()
        for i, j in runs:
            n = sum(len(words(x)) for x in lines[i:j])
            if tuple(lines[i:j]) in earlier and n >= p.noise:
                may.update(range(i, j))
                if n >= p.guarantee:
                    must.update(range(i, j))
        left = out[(d, text)].new_text.split("\n")
        gone = [i for i, x in enumerate(lines) if x not in left]
        assert set(gone) <= may, d
        # every long enough repeat loses at least its fingerprint and what extends it
        assert sum(len(words(lines[i])) for i in must - set(gone)) < p.guarantee, d
        earlier.update(tuple(lines[i:j]) for i, j in runs)


def test_awkward_rows(awkward):
    out = line_dedup(awkward).selectExpr("row.doc_id", "row.text", "new_text", "removed_lines").collect()
    assert len(out) == awkward.count()
    for r in out:
        if r.text is None or not words(r.text):
            assert r.new_text == r.text and r.removed_lines == 0
    assert sum(r.new_text == "" and bool(r.text) for r in out) == 3        # a repeated row and two later copies (no id: last)
    mixed = next(r for r in out if r.doc_id == 8)
    assert mixed.new_text == "\n".join(mixed.text.split("\n")[:2])
    kept = drop_repeated_lines(awkward)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 3
    assert all(r.n_chars == len(r.text) for r in kept.collect() if r.text is not None)
    assert drop_repeated_lines(awkward.limit(0)).count() == 0


def test_copies_keep_the_first(documents):
    out = line_dedup(documents, keep=["doc_id"]).selectExpr("row.doc_id", "row.text", "new_text").collect()
    first = {}
    for r in sorted(out, key=lambda r: r.doc_id):
        if len(words(r.text)) >= 50:
            if r.text in first:
                assert not words(r.new_text), r.doc_id
            first.setdefault(r.text, r.doc_id)


def test_a_repeat_is_extended_against_all_earlier_places(spark):
    """Q+P stands in documents 2 and 4 with P alone between: document 4 goes whole."""
    docs = []
    for k in range(12):
        p, q = long_line(f"p{k}x", 60), long_line(f"q{k}x", 20)
        docs += [(10 * k + d, t) for d, t in enumerate([p, q + "\n" + p, p, q + "\n" + p, p + "\n" + q, p, p + "\n" + q])]
    out = {d: r for (d, _), r in by_text(line_dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(7))).items()}
    for k in range(12):
        q = long_line(f"q{k}x", 20)
        assert [out[10 * k + d].new_text for d in range(1, 7)] == [q, "", "", q, "", ""], k


def test_every_line_of_every_repeat_over_the_guarantee_goes(spark):
    rng = random.Random(11)
    pool = [long_line(f"l{k}w", rng.randint(1, 30)) for k in range(30)]
    docs = []
    for d in range(120):
        a = rng.randrange(25)
        docs.append((d, "\n".join([long_line(f"own{d}a", 9), *pool[a: a + rng.randint(1, 12)], long_line(f"own{d}b", 9)])))
    p = LineParams()
    out = by_text(line_dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(6)))
    earlier = set()
    for d, text in docs:
        lines = text.split("\n")
        runs = [(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines) + 1)]
        must, may = set(), set()
        for i, j in runs:
            n = sum(len(words(x)) for x in lines[i:j])
            if tuple(lines[i:j]) in earlier:
                may.update(range(i, j) if n >= p.noise else ())
                must.update(range(i, j) if n >= p.guarantee else ())
        left = out[(d, text)].new_text.split("\n")
        gone = {i for i, x in enumerate(lines) if x not in left}
        assert must <= gone <= may, d
        earlier.update(tuple(lines[i:j]) for i, j in runs)
