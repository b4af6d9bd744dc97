"""Ranked search against a plain scorer of all documents."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabline.llm.search import SearchParams, mask_groups, ranked_search
from .conftest import AWKWARD

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top):
    docs = [(k, terms(t)) for k, t in docs]
    docs = [(k, t) for k, t in docs if t]
    n_docs, n_terms = len(docs), sum(len(t) for _, t in docs)
    out = []
    for key, text in items:
        scored = []
        weight = {}
        for term in set(terms(text)):
            df = sum(term in t for _, t in docs)
            weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        for k, t in docs:
            m = 75 + (25 * len(t) * n_docs) // n_terms
            score = sum(weight[x] * ((10**9 * t.count(x)) // (1000 * t.count(x) + 12 * m)) for x in terms(text))
            if score > 0:
                scored.append((-score, k is None, k or 0, k))
        out += [(key, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:top])]
    return out


def listed(df):
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted((tuple(r) for r in df.collect()), key=key)


@pytest.mark.parametrize("params", [SearchParams(), SearchParams(top=3, item_bytes=400, lists=1, postings=16)])
def test_same_as_scoring_every_document(spark, params):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "straße"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda n: " ".join(rng.choices(vocabulary, weights, k=n))
    docs = [(i, text(rng.randint(1, 40))) for i in range(300)] + [(400 + i, "W3 w3, w5-w7") for i in range(40)]
    items = [(i, text(rng.randint(1, 30))) for i in range(12)] + [(50, "w3 w3 W5"), (51, "nowhere"), (52, "w1 " * 9)]
    items.append((53, " ".join(vocabulary) + " " + " ".join(f"more{i}" for i in range(90))))     # over 64 terms
    got = ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(7),
                        spark.createDataFrame(items, "item_id long, text string"), params=params)
    key = lambda r: tuple((x is None, x) for x in r)
    assert listed(got) == sorted(brute(docs, items, params.top), key=key)


def test_awkward_rows(spark, awkward):
    items = [(1, AWKWARD[0][1]), (None, "three short words"), (2, None), (3, ""), (4, "word1x1"), (4, "word1x1")]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("mine")).withColumn("doc_id", F.lit(1))
    key = lambda r: tuple((x is None, x) for x in r)
    assert listed(ranked_search(awkward, frame)) == sorted(brute([(r[0], r[1]) for r in AWKWARD], items, 20), key=key)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for d, i in ((docs.where("false"), items), (docs, items.where("false")), (docs, items.withColumn("text", F.lit(None).cast("string")))):
        out = ranked_search(d, i)
        assert out.columns == ["item", "rank", "doc", "score"] and out.count() == 0


def test_groups_hold_equal_masks():
    rows = [np.array([0, 2, 5]), np.array([2, 5, 6])] + [np.array([], int)] * 70 + [np.array([6])]
    bits, docs, starts = mask_groups(rows, 8)
    held = {tuple(np.flatnonzero(b)): sorted(docs[starts[i]: starts[i + 1]].tolist()) for i, b in enumerate(bits)}
    assert held == {(0,): [0], (0, 1): [2, 5], (1, 72): [6]}
