import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabline.llm import lm as M
from .conftest import words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*words((text or "").translate(LOWER)), None]


def unigram(texts, train):
    c = Counter(t for x in train for t in tokens(x))
    n, v = sum(c.values()), len(c)
    return n, [(len(tokens(x)), sum(c[t] > 0 for t in tokens(x)), sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(x))) for x in texts]


@pytest.mark.parametrize("head", [131_072, 50, 0])
def test_base_scores_match_brute_force(documents, head):
    model = M.train_lm(documents.where(M.may_train(F.col("doc_id"))), M.LmParams(head=head))
    rows = M.score_lm(documents, model).select("row.doc_id", "row.text", "n_tokens", "n_known", "base_score", "score").collect()
    n, want = unigram([r.text for r in rows], [r.text for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 != 1])
    assert model.tokens == n
    for r, (size, known, base) in zip(rows, want):
        assert (r.n_tokens, r.n_known) == (size, known) and r.base_score == pytest.approx(base, rel=1e-9)
    # contexts help on what was learned from, and cost little elsewhere
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_context_probabilities_sum_to_one():
    p = M.LmParams(classes=4, members=4, own=3, rows=64, batch=8)
    rng = np.random.default_rng(0)
    own = rng.integers(1, 1 << 60, 3).astype(np.uint64)
    slots = M.Slots(p, own, own, np.array([5, 4, 3]), rng.integers(1, 9, 16).astype(float), np.ones(16))
    tok = rng.choice(np.concatenate([own, rng.integers(1, 1 << 60, 5).astype(np.uint64)]), 40)
    ptr = np.array([0, 7, 8, 40])
    w1, w2 = (rng.normal(size=(64, 4)).astype(np.float32) for _ in range(2))
    total = sum(10 ** M.model_log10(w1, w2, slots, tok, ptr, np.full(40, s)) for s in range(16))
    assert np.allclose(total, 1, atol=1e-5)


def test_gradient_steps_learn_a_pattern():
    p = M.LmParams(classes=4, members=4, own=8, rows=256, batch=64)
    own = M.C.mix64(np.arange(8, dtype=np.uint64))
    slots = M.Slots(p, own, own, np.full(8, 9), np.full(16, 9.0), np.ones(16))
    tok, ptr = np.tile(own, 64), np.array([0, 512])
    w1, w2 = np.zeros((256, 4), np.float32), np.zeros((256, 4), np.float32)
    before = M.model_log10(w1, w2, slots, tok, ptr, slots.slot(tok)).sum()
    for _ in range(10):
        M.train_block(w1, w2, slots, tok, ptr)
    assert M.model_log10(w1, w2, slots, tok, ptr, slots.slot(tok)).sum() > 0.3 * before


def test_contexts_stay_inside_texts():
    tok = np.arange(1, 9, dtype=np.uint64)
    both = M.contexts(tok, np.array([0, 3, 4, 8]), 1 << 40)
    alone = np.concatenate([M.contexts(tok[a:b], np.array([0, b - a]), 1 << 40) for a, b in ((0, 3), (3, 4), (4, 8))], axis=1)
    assert np.array_equal(both, alone)


def test_awkward_rows(awkward):
    model = M.train_lm(awkward)
    out = M.score_lm(awkward, model)
    rows = out.select("row.doc_id", "row.text", "n_tokens", "n_known", "base_score", out["score"].alias("s")).collect()
    texts = [r[0] for r in awkward.select("text").collect()]
    n, want = unigram([r.text for r in rows], texts)
    assert n == model.tokens
    for r, (size, known, base) in zip(rows, want):
        assert (r.n_tokens, r.n_known) == (size, known) and r.base_score == pytest.approx(base, rel=1e-9)
        assert math.isfinite(r.s) and r.s < 0
    assert M.score_lm(awkward.limit(0), model).count() == 0
    empty = M.train_lm(awkward.limit(0))
    assert all(math.isfinite(r[0]) for r in M.score_lm(awkward, empty).select("score").collect())
