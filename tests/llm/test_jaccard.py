from collections import Counter, defaultdict

import numpy as np
import pytest
from cabline.llm.jaccard import JaccardParams, drop_near_copies, jaccard_links, node_links
from .conftest import roots, shingles


def brute(texts):
    """(number of links, smallest linked row) per row, from all pairs that share a shingle."""
    sets = {k: shingles(t) for k, t in texts.items()}
    holds = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            holds[x].append(k)
    n, links = Counter(), []
    for k, s in sets.items():
        shared = Counter(o for x in s for o in holds[x])
        for o, c in shared.items():
            if o != k and 5 * c >= 4 * (len(s) + len(sets[o]) - c):
                n[k] += 1
                links.append((k, o))
    return n, roots(sets, links)


@pytest.mark.parametrize("params", [JaccardParams(), JaccardParams(tile=2, tile_shingles=100)])
def test_links_match_brute_force(documents, params):
    rows = jaccard_links(documents, params, keep=["doc_id"]).selectExpr("rid", "row.text", "n_links", "class_rid").collect()
    n, root = brute({r.rid: r.text for r in rows})
    assert {r.rid: (r.n_links, r.class_rid) for r in rows} == {r.rid: (n[r.rid], root[r.rid]) for r in rows}
    assert sum(n.values()) > 0


def test_awkward_rows(awkward):
    rows = jaccard_links(awkward).selectExpr("rid", "row.text", "n_links", "class_rid").collect()
    n, root = brute({r.rid: r.text for r in rows})
    assert {r.rid: (r.n_links, r.class_rid) for r in rows} == {r.rid: (n[r.rid], root[r.rid]) for r in rows}
    kept = drop_near_copies(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == len(set(root.values()))
    assert drop_near_copies(awkward.limit(0)).count() == 0


def test_prefix_reaches_recall():
    p = JaccardParams()
    d = p.prefix()
    assert 1 - (1 - p.threshold**d) ** p.trees >= p.recall
    assert d == p.label or 1 - (1 - p.threshold ** (d + 1)) ** p.trees < p.recall


def test_large_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:i % 60] + [f"new{i}"] + base[i % 60 + 1:]) for i in range(700)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = jaccard_links(docs).selectExpr("rid", "row.text", "n_links", "class_rid").collect()
    n, root = brute({r.rid: r.text for r in rows})
    got = {r.rid: (r.n_links, r.class_rid) for r in rows}
    assert got == {r.rid: (n[r.rid], root[r.rid]) for r in rows}


def test_matching_goes_from_long_prefixes_to_short_ones():
    """In a trie node: a large group of equal paths rests where it met, single classes go on
    to the node's own depth, and every near pair of a class that goes on is met."""
    p = JaccardParams()
    rng = np.random.default_rng(0)
    d, n, tree = p.prefix(), p.trees * p.label, 5
    assert d < p.label
    group = np.repeat(rng.integers(0, 256, (1, n), dtype=np.uint8), 60, axis=0)
    for row in group:
        at = rng.choice(n, 6, replace=False)
        at = at[(at < tree * p.label) | (at >= (tree + 1) * p.label)]
        row[at] = rng.integers(0, 256, len(at))
    near = group[:2].copy()
    near[:, tree * p.label + d] = [7, 9]                        # leave the group's path below the node
    alone = rng.integers(0, 256, (3, n), dtype=np.uint8)
    sig = np.concatenate([group, near, alone])
    floor = int((p.threshold - p.slack) * n)
    order, left, right = node_links(p, sig, tree, floor)
    met = {(int(order[a]), int(order[b])) for a, b in zip(left, right)}
    want = {(a, b) for a in range(len(sig)) for b in range(len(sig)) if a != b and (sig[a] == sig[b]).sum() >= floor}
    assert met <= want
    assert {(a, b) for a, b in want if a < 60 and b < 60} <= met and {(a, b) for a, b in want if a >= 60} <= met
    assert not {(a, b) for a, b in met if a < 60 <= b}             # the group rested before
    eager = JaccardParams(recall=0.5)
    assert eager.prefix() == eager.label                            # nothing to shorten
    patient = JaccardParams(recall=0.999999999)
    order, left, right = node_links(patient, sig, tree, floor)
    assert {(int(order[a]), int(order[b])) for a, b in zip(left, right)} == want


@pytest.mark.parametrize("threshold", [0.5, 0.9])
def test_recall_against_all_pairs(documents, threshold):
    """Links found against all pairs that share a shingle, at several thresholds."""
    rows = jaccard_links(documents, JaccardParams(threshold=threshold), keep=["doc_id"]).selectExpr("rid", "row.text", "n_links").collect()
    sets = {r.rid: shingles(r.text) for r in rows}
    holds, n = defaultdict(list), Counter()
    for k, s in sets.items():
        for x in s:
            holds[x].append(k)
    for k, s in sets.items():
        for o, c in Counter(o for x in s for o in holds[x]).items():
            n[k] += o != k and c >= threshold * (len(s) + len(sets[o]) - c) - 1e-9
    found, want = sum(r.n_links for r in rows), sum(n.values())
    assert want > 0 and 0.99 * want <= found <= want


def test_long_chain_of_near_copies(spark):
    """Each text is near the next one only: all links of the chain, and no other."""
    words, texts = [f"c{i}" for i in range(1, 400 * 3 + 90)], []
    texts = [" ".join(words[3 * i: 3 * i + 70]) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = jaccard_links(docs, JaccardParams(tile=32)).selectExpr("rid", "row.text", "n_links", "class_rid").collect()
    n, root = brute({r.rid: r.text for r in rows})
    assert {r.rid: (r.n_links, r.class_rid) for r in rows} == {r.rid: (n[r.rid], root[r.rid]) for r in rows}
    assert len(set(root.values())) == 1 and max(n.values()) <= 4
