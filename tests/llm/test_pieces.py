import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabline.llm import pieces as P

pytestmark = pytest.mark.skipif(not os.path.exists(P.PieceParams().model), reason="needs the public vocabulary file")


@pytest.fixture(scope="module")
def model():
    p = P.PieceParams()
    return P.load(P._proto(p), p.penalty)


def every_path(model, seg, n):
    """The n best segmentations from a list of all of them."""
    into = model.edges(seg)
    paths = {0: [(0.0, ())]}
    for j in range(1, len(seg) + 1):
        both = [(s + t, path + ((i, j, p),)) for i, s, p in into[j] for t, path in paths.get(i, [])]
        paths[j] = sorted(both, key=lambda x: -x[0])[:60]
    return [(s, model.spell(seg, list(path))) for s, path in paths[len(seg)][:n]]


def test_segments_against_all_paths(model):
    rng = random.Random(0)
    segs = [b" hello", b" ", b"  ", b"   x", b"\n", " étreaux".encode(), "日本語テキスト".encode(), b" internationalization", "▁x".encode(), b" aaaaaaaaaa", b"\t\x00", " 🎉a".encode(), b" " + b"ab" * 40]
    segs += [(" " + "".join(rng.choice(["th", "er", "a", "é", "1", "ß", "q"]) for _ in range(rng.randint(1, 10)))).encode() for _ in range(80)]
    size = np.array([len(s) for s in segs])
    flat, begin, count, score, loss = model.solve(np.frombuffer(b"".join(segs), np.uint8), np.cumsum(size) - size, size)
    for k, s in enumerate(segs):
        want, got = every_path(model, s, 6), model.nbest(s, 6)
        assert [x[0] for x in got] == [x[0] for x in want]
        assert len({tuple(x[1]) for x in got}) == len(got)
        ids = flat[begin[k]: begin[k] + count[k]].tolist()
        assert score[k] == want[0][0] and ids == got[0][1]
        assert loss[k] == (want[0][0] - want[1][0] if len(want) > 1 else np.inf)
        assert b"".join(model.text[i] for i in ids) == s


def test_whole_texts(spark, model):
    texts = ["Hello world\nfoo  bar ▁ x", None, "", " lead", "é" * 3, "a b", "\n\n", "tail ", "x" * 500 + " y", "a" * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "n int, text string").withColumn("ids", F.lit("mine"))
    out = P.encode(docs).withColumn("back", P.decode(F.col("ids"))).collect()
    for r in out:
        text = r.row.text or ""
        assert r.back == text and r.row.ids == "mine"
        if not text:
            assert r.ids == [] and r.score == 0 and r.others == []
            continue
        if len(text) < 60:
            want = every_path(model, (" " + text).encode(), 4)
            assert [r.score] + [o.score for o in r.others] == [s for s, _ in want]
        for o in r.others:
            ids = list(r.ids)
            for e in sorted(o.edits, key=lambda e: -e["at"]):
                ids[e["at"]: e["at"] + e["n"]] = e["ids"]
            assert b"".join(model.text[i] for i in ids) == (" " + text).encode() and ids != r.ids


def test_round_trip_of_awkward_rows(awkward):
    out = P.encode(awkward, columns=["doc_id", "text"]).withColumn("back", P.decode(F.col("ids")))
    assert out.where("back <> coalesce(row.text, '')").count() == 0
    assert out.count() == awkward.count()
    assert P.encode(awkward, columns=["doc_id"], verify=True).where("NOT same").count() == 0
    assert P.encode(awkward.limit(0)).count() == 0


def test_round_trip_of_the_table(documents):
    out = P.encode(documents, columns=["text"]).withColumn("back", P.decode(F.col("ids")))
    assert out.where("back <> coalesce(row.text, '')").count() == 0
