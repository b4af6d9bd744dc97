import numpy as np
import pytest

from cabline.llm.vectors import VectorParams, drop_near_vectors, vector_links
from .conftest import roots


def brute(rows, threshold=0.95):
    """(links, smallest linked row) of every rid -> vector."""
    good = {k: np.array(v, float) for k, v in rows.items() if v and None not in v and np.isfinite(v).all() and np.any(v)}
    n, links = dict.fromkeys(rows, 0), []
    for dim in {len(v) for v in good.values()}:
        ids = [k for k, v in good.items() if len(v) == dim]
        x = np.stack([good[k] / np.abs(good[k]).max() for k in ids])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        a, b = np.nonzero(x @ x.T >= threshold)
        for i, j in zip(a, b):
            if i != j:
                n[ids[i]] += 1
                links.append((ids[i], ids[j]))
    return n, roots(rows, links)


def check(df, column, params=None):
    rows = vector_links(df, column, params).select("rid", f"row.{column}", "n_links", "class_rid").collect()
    n, root = brute({r.rid: r[column] for r in rows})
    assert {r.rid: (r.n_links, r.class_rid) for r in rows} == {r.rid: (n[r.rid], root[r.rid]) for r in rows}
    return rows


def test_exact_on_the_table_and_on_dense_groups(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(6, 24))
    near = [c + rng.normal(size=24) * s for c in centre for s in (0.05, 0.2, 0.3) for _ in range(60)]
    chain = [np.append(np.zeros(20), [np.cos(t), np.sin(t), 0, 0]) for t in np.arange(0, 2, 0.15)]
    rows = [(k, [float(x) for x in v]) for k, v in enumerate([*near, *chain, *rng.normal(size=(400, 24))])]
    df = spark.createDataFrame(rows, "vec_id long, v array<float>").repartition(6)
    got = check(df, "v")
    assert sum(r.n_links for r in got) > 1000
    check(df, "v", VectorParams(block=16))


def test_awkward_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [-1.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, []), (7, [float("nan"), 1.0]),
            (8, [float("inf"), 1.0]), (9, [None, 1.0]), (None, [1.0, 0.1]), (None, None), (10, [1.0, 0.0, 0.0]), (11, [1e-30, 1e-32]), (12, [1e300, 1e298]), (13, [0.0, -0.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>").selectExpr("*", "'mine' AS rid", "'mine' AS vec", "1 AS weight", "2 AS home")
    check(df, "v")
    kept = drop_near_vectors(df, "v")
    assert kept.columns == df.columns and kept.count() == 11
    assert drop_near_vectors(df.limit(0), "v").count() == 0
    assert vector_links(df.where("vec_id = 5"), "v").select("n_links").first().n_links == 0


def test_recall_of_a_narrow_margin(spark):
    """A smaller share of the margin trades links for less copying; here it still finds 9 of 10."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 32))
    x = np.concatenate([x, x + rng.normal(size=x.shape) * 0.2])
    df = spark.createDataFrame([(k, [float(e) for e in v]) for k, v in enumerate(x)], "vec_id long, v array<float>")
    exact = vector_links(df, "v").agg({"n_links": "sum"}).first()[0]
    narrow = vector_links(df, "v", VectorParams(spill=0.5)).agg({"n_links": "sum"}).first()[0]
    assert 0.9 * exact <= narrow <= exact
    assert exact == pytest.approx(sum(brute({k: list(v) for k, v in enumerate(x.astype(np.float32))})[0].values()))
