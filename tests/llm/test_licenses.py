import random
import re

from cabline.llm import licenses as L

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text, p):
    text = (text or "").translate(LOWER)
    w = WORD.findall(text)
    base, starts = set(), []
    for phrase, label in p.phrases:
        seq = phrase.split()
        at = [i for i in range(len(w)) if w[i: i + len(seq)] == seq]
        starts += at
        base |= {label} if at else set()
    found = {}
    for k, (t, label, share) in enumerate(p.all_templates()):
        seq = WORD.findall(t.translate(LOWER))
        n, t = -(-len(seq) * 5 // 4), set(seq)
        if len(t & set(w)) >= share * len(t) - 1e-9:
            best = max((len(t & set(w[i: i + n])) for i in range(len(w))), default=0)
            if best >= share * len(t) - 1e-9:
                found[k] = best / len(t)
    labels = base | {p.all_templates()[k][1] for k in found}
    score = 1.0 if base else max(found.values(), default=0.0)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), sorted(base), sorted(labels), score, found


def check(df, p=None):
    p = p or L.LicenseParams()
    rows = L.scan_licenses(df, p).selectExpr("row.text", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches").collect()
    for r in rows:
        best = {}
        for m in r.matches:
            best[m.template] = max(best.get(m.template, 0), m.share)
        assert (*list(r[1:8]), best) == brute(r.text, p), r.text
    return rows


def test_same_as_all_pairs(spark):
    rng = random.Random(1)
    vocab = sorted({w for t, _ in L.TEMPLATES for w in t.split()}) + [f"w{i}" for i in range(10)]
    texts = ["\n".join(" ".join(rng.choices(vocab, k=rng.randint(0, 25))) for _ in range(rng.randint(0, 4))) for _ in range(400)]
    for notice, _ in L.TEMPLATES:
        w = notice.split()
        texts += [notice.upper(), " ".join(w[1:]), "x " + ", ".join(reversed(w)) + " y", " ".join(w[: len(w) // 2]) + "\n" + " ".join(w[len(w) // 2:])]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for threshold in (0.9, 0.6):
        assert sum(len(r.labels) > 0 for r in check(df, L.LicenseParams(threshold=threshold, notice_threshold=threshold))) > 40


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""


def test_wrapped_notices_are_found_and_scattered_words_are_not(spark):
    rng = random.Random(5)
    far = [f"w{i}" for i in range(2_000)]
    for i, w in zip(rng.sample(range(2_000), 200), WORD.findall(MIT.translate(LOWER)) * 4):
        far[i] = w
    texts = [("wrapped", MIT), ("short", "some text\nlicensed under the MIT\nlicense, and more"), ("far", " ".join(far))]
    got = {r.k: r for r in L.scan_licenses(spark.createDataFrame(texts, "k string, text string")).selectExpr("row.k", "labels", "score").collect()}
    assert got["wrapped"].labels == ["mit"] and got["wrapped"].score == 1.0
    assert got["short"].labels == ["mit"] and got["short"].score == 1.0
    assert got["far"].labels == [] and got["far"].score == 0.0


def test_every_filter_rejects_and_none_loses(spark):
    """Texts of template words at large: each filter turns some places away, and what is
    found is what looking at every stretch finds."""
    rng = random.Random(6)
    p = L.LicenseParams()
    vocab = sorted({w.decode() for t, _, _ in p.all_templates() for w in L.words_of(t)})
    texts = [" ".join(rng.choices(vocab, k=rng.randint(3, 30)) + [f"x{i}" for i in range(rng.randint(0, 60))] + rng.choices(vocab, k=9)) for _ in range(150)]
    texts += [" ".join(w for w in t.split() if rng.random() < 0.85) for t, _ in p.notices for _ in range(5)]
    counts = {}
    for t in texts:
        for w in L.words_of(t):
            counts[w] = counts.get(w, 0) + 1
    index = L.Index(p, counts)
    for t in texts:
        w = L.words_of(t)
        whole = {(k, *x) for k in range(len(index.sets)) for x in index.places(k, w, 0, len(w))}
        found = {(m["template"], m["first"], m["last"], round(m["share"] * len(index.sets[m["template"]]))) for m in index.find(w)}
        assert found == whole
    assert min(index.seen.values()) > 0 and index.seen["counted"] < index.seen["prefix"] / 2, index.seen


def test_table_and_awkward_rows(documents, awkward):
    check(documents)
    assert len(check(awkward)) == awkward.count()
    assert L.scan_licenses(awkward).select("row.*").columns == awkward.columns
    assert L.scan_licenses(awkward.limit(0)).count() == 0


def test_notices_over_line_breaks_and_with_other_words(spark):
    """Hard-wrapped license paragraphs, one word in ten changed, are found with all that meets its threshold."""
    rng = random.Random(2)
    texts = []
    for notice, label in L.NOTICES:
        w = notice.split()
        for k in range(0, len(w), 10):
            w[k] = f"other{k}"
        plain = " ".join(f"word{rng.randrange(500)}" for _ in range(200))
        texts.append((label, plain + "\n * " + "\n * ".join(" ".join(w[i: i + 7]) for i in range(0, len(w), 7)) + "\n\n" + plain))
    texts.append(("none", " ".join(w for notice, _ in L.NOTICES for w in [*notice.split()[::4], *["gap"] * 40])))
    wrapped = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software"
    texts.append(("mit", wrapped))
    df = spark.createDataFrame(texts, "label string, text string")
    size = len(L.TEMPLATES)
    for r in L.scan_licenses(df).selectExpr("row.label", "row.text", "matches AS notices").collect():
        found = {n.label for n in r.notices if r.text == wrapped or n.template >= size}
        assert (r.label in found) if r.label != "none" else not found, r.label
        w = WORD.findall(r.text.translate(LOWER))
        for n in r.notices:
            words = {x.decode() for x in L.words_of((L.TEMPLATES + L.NOTICES)[n.template][0])}
            assert n.share >= (0.95 if n.template < size else 0.8) and w[n.first] in words and w[n.last] in words


def test_every_stretch_is_looked_at_and_less_specific_ones_are_marked(spark):
    rng = random.Random(3)
    p = L.LicenseParams(threshold=0.75, templates=(("a b c d", "x"), ("a b c d e f", "y"), ("g h i", "z")), notices=(("a b g h j", "w"),), notice_threshold=0.8)
    df = spark.createDataFrame([("\n".join(rng.choices("abcdefghijklmnop", k=rng.randint(0, 40))),) for _ in range(300)], "text string")
    both = [(set(t.split()), share, len(t.split())) for t, share in [*[(t, 0.75) for t, _ in p.templates], ("a b g h j", 0.8)]]
    for r in L.scan_licenses(df, p).selectExpr("row.text", "matches AS notices").collect():
        w = r.text.split("\n")
        want = {}
        for k, (t, share, size) in enumerate(both):
            n = -(-size * 5 // 4)
            best = max((len(t & set(w[i: i + n])) for i in range(len(w))), default=0)
            if best >= share * len(t) - 1e-9:
                want[k] = best / len(t)
        got = {}
        for n in r.notices:
            got[n.template] = max(got.get(n.template, 0), n.share)
            over = any(both[n.template][0] < both[m.template][0] and m.first <= n.last and n.first <= m.last for m in r.notices)
            assert n.specific == (not over)
        assert got == want, r.text
