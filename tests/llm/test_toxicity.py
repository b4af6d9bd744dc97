import random

import numpy as np
from pyspark.sql import functions as F

from cabline.llm import toxicity as T
from cabline.llm.common import held_out

SMALL = T.ToxicityParams(bits=18, sample=600, features=512, rounds=150)


def corpus(n=1200):
    rng = random.Random(9)
    vocab = ["".join(rng.choices("abdefghiklmnorstu", k=rng.randint(2, 8))) for _ in range(400)]
    rows = []
    for d in range(n):
        w = rng.choices(vocab, k=rng.randint(5, 300))
        toxic = d % 5 == 0
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(["Scoundrel", "nitwit", "blockhead"]))
        rows.append((d, " ".join(w), int(toxic)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int")
    model = T.train_toxicity(docs, labels, ~held_out(F.col("doc_id"), 0), SMALL)
    got = T.score_toxicity(docs, model).select("row.doc_id", "score", held_out(F.col("row.doc_id"), 0).alias("h")).collect()
    new = [(r.score >= 0.5, rows[r.doc_id][2]) for r in got if r.h]
    assert len(new) > 150 and np.mean([p == y for p, y in new]) > 0.97
    # labels of held-out texts change nothing
    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id"), 0), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = T.train_toxicity(docs, turned, ~held_out(F.col("doc_id"), 0), SMALL)
    assert np.array_equal(model.buckets, again.buckets) and np.allclose(model.weight, again.weight)


def test_buckets_depend_on_the_text_alone(monkeypatch):
    import pyarrow as pa
    from cabline.llm import common as C

    texts = ["Some text, ünïcode 日本", "", "ab", "abc" * 400, "Some text, ünïcode 日本"]
    raw, off = C.text_buffers(pa.array(texts))
    row, bucket = T._present(raw, off, SMALL)
    sets = [set(bucket[row == r]) for r in range(len(texts))]
    assert sets[0] == sets[4] and not sets[1] and not sets[2]
    one, off1 = C.text_buffers(pa.array([texts[0].swapcase().swapcase()]))
    assert set(T._present(one, off1, SMALL)[1]) == sets[0]


def test_awkward_rows(awkward, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (4, 0), (8, 1), (99, 1)], "doc_id long, toxic int")
    model = T.train_toxicity(awkward, labels, F.lit(True), SMALL)
    out = T.score_toxicity(awkward, model)
    rows = out.select("row.doc_id", "row.text", out["score"].alias("s")).collect()
    assert len(rows) == awkward.count() and all(0 <= r.s <= 1 for r in rows)
    assert len({r.s for r in rows if not r.text}) == 1
    for none in (labels.limit(0), labels.where("toxic = 1")):
        flat = T.train_toxicity(awkward, none, F.lit(True), SMALL)
        assert T.score_toxicity(awkward, flat).select("score").distinct().count() == 1
    assert T.score_toxicity(awkward.limit(0), model).count() == 0


def test_ratios_and_scores_by_plain_counting(spark):
    """Features, log-count ratios, fit and scores from sets of n-grams in plain Python."""
    p = T.ToxicityParams(bits=16, sample=600, features=64, rounds=40, chunk=1 << 16, sizes=(3, 4))
    rows = corpus(60)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int")
    model = T.train_toxicity(docs, labels, F.lit(True), p)

    def bucket(gram):
        raw = np.frombuffer(gram.encode(), np.uint8)
        return next(int(b[0]) for b, n in T.gram_buckets(raw, np.array([0, len(raw)]), p.sizes, p.bits)[0] if n == len(gram))

    texts = [t.lower() for _, t, _ in rows]
    sets = [{bucket(t[i: i + n]) for n in p.sizes for i in range(len(t) - n + 1)} for t in texts]
    y = np.array([r[2] for r in rows], float)
    n = np.array([(y == c).sum() for c in (0, 1)], float)
    held = {b: [sum(b in s for s, v in zip(sets, y) if v == c) for c in (0, 1)] for b in set().union(*sets)}

    def evidence(k):
        share = sum(k) / n.sum()
        return sum(x * np.log(x / (m * e)) for c in (0, 1) for x, m, e in ((k[c], n[c], share), (n[c] - k[c], n[c], 1 - share)) if x > 0 and e > 0)

    top = sorted(b for _, b in sorted((-round(evidence(k), 9), b) for b, k in held.items())[: p.features])
    least = min(evidence(held[b]) for b in top)
    # ties at the end of the list may be broken either way
    assert {b for b, k in held.items() if evidence(k) > least + 1e-6} <= set(model.buckets.tolist())
    assert all(evidence(held[b]) > least - 1e-6 for b in model.buckets.tolist()) and len(model.buckets) == len(top)
    ratio = np.array([np.log((held[b][1] + 1) / (n[1] + 2) / ((held[b][0] + 1) / (n[0] + 2))) for b in model.buckets.tolist()])
    x = np.array([[b in s for b in model.buckets.tolist()] for s in sets]) * ratio
    w, m, v = (np.zeros(len(ratio) + 1) for _ in range(3))
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    for t in range(1, p.rounds + 1):
        e = (1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))) - y) / len(y)
        g = np.append(x.T @ e + p.l2 * w[:-1], e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    assert np.allclose(model.weight, w[:-1] * ratio, atol=1e-6) and np.isclose(model.bias, w[-1], atol=1e-6)
    got = {r.doc_id: r.score for r in T.score_toxicity(docs, model).select("row.doc_id", "score").collect()}
    assert np.allclose([got[d] for d, *_ in rows], 1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))), atol=1e-6)
