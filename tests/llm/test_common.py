import numpy as np
import pyarrow as pa

from cabline.llm import common as C
from .conftest import roots, words


def test_tokens_match_regex_in_any_window(monkeypatch):
    texts = ["hello world  foo", None, "", "a b c d e f g", "  x\ty\n", "étre à la " * 50, "z" * 300, "a b c d e f g"]
    for window in (16, 64, 1 << 20):
        monkeypatch.setattr(C, "WINDOW_BYTES", window)
        C._powers.clear()
        raw, off = C.text_buffers(pa.array(texts))
        start, end, h, ptr = C.tokens(raw, off)
        seen = {}
        for r, t in enumerate(texts):
            got = [bytes(raw[start[i]: end[i]]).decode() for i in range(ptr[r], ptr[r + 1])]
            assert got == words(t)
            for i, w in zip(range(ptr[r], ptr[r + 1]), got):
                assert seen.setdefault(w, h[i]) == h[i]
        assert len(set(seen.values())) == len(seen)
        runs, rptr = C.window_hashes(h, ptr, 5)
        assert list(np.diff(rptr)) == [1, 0, 0, 3, 1, 146, 1, 3]
        assert (runs[rptr[3]: rptr[4]] == runs[rptr[7]: rptr[8]]).all()
    C._powers.clear()


def test_components_of_chains_hubs_and_random_edges(spark):
    rng = np.random.default_rng(0)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))]
    pairs += [(1000, x) for x in range(2000, 2200)] + [(x, x + 1) for x in range(5000, 5040)] + [(7, 7)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.component for r in C.components(edges)[0].collect()}
    links = [(a, b) for a, b in pairs if a != b]
    assert got == roots({x for p in links for x in p}, links)
    assert C.components(edges.limit(0))[0].count() == 0
