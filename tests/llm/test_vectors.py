import numpy as np
import pytest

from tidemark.llm import vectors as V

ROW = "vec_id long, embedding array<float>, score string, rank int, block int, shard int, v string, least int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2, 3, "y", 4) for i, v in rows], ROW)


def some(seed=1, n=300, d=9):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d)).astype(np.float32)
    x[n // 2 :] = x[: n - n // 2]  # ties
    rows = [(i, x[i].tolist()) for i in range(n)]
    rows += [(1000, None), (1020, []), (1040, [1.0, None]), (1060, [float("nan")] * d), (1080, [float("inf")] * d), (None, x[0].tolist()), (1100, [0.0] * d), (1120, [0.5]), (3, x[9].tolist()), (3, x[9].tolist())]
    return rows


def brute(rows, k, every, measure, zero):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    good = [(i, v) for i, v in good if zero or v.any()]
    width = max(len(v) for _, v in good)
    good = [(i, np.pad(v, (0, width - len(v)))) for i, v in good]
    queries = {}
    for i, v in good:
        if i % every == 0:
            queries[i] = min(queries.get(i, v.tolist()), v.tolist())
    out = set()
    for q, v in queries.items():
        found = sorted((-measure(np.array(v), w), i) for i, w in good if i != q)[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found)}
    return out


def whole(a, b):
    return int(np.floor(256 * a) @ np.floor(256 * b))


def plain(a, b):
    s = 0.0
    for x, y in zip(a, b, strict=True):
        s += x * y
    return s


def listed(df):
    assert df.columns[:4] == ["query_id", "rank", "vec_id", "score"]
    return {(r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect()}


@pytest.mark.parametrize("shard", [8192, 40])
def test_top_k_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(V, "SHARD", shard)  # also over several shards
    monkeypatch.setattr(V, "QUERY_BLOCK", shard // 8)
    rows = some()
    assert listed(V.exact_top_k(frame(spark, rows))) == brute(rows, 5, 50, whole, True)


@pytest.mark.parametrize("shard", [8192, 40])
def test_nearest_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(V, "SHARD", shard)
    monkeypatch.setattr(V, "QUERY_BLOCK", shard // 8)
    rows = some(2)
    assert listed(V.nearest(frame(spark, rows))) == brute(rows, 20, 20, plain, False)


def test_empty_and_few(spark):
    assert V.exact_top_k(frame(spark, [])).collect() == [] == V.nearest(frame(spark, [])).collect()
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5])]
    assert listed(V.exact_top_k(frame(spark, rows))) == {(0, 1, 1, 256 * 128 + 512 * 128)}
    assert listed(V.nearest(frame(spark, rows))) == {(0, 1, 1, 1.5)}


def test_ball_tree_bounds_hold_and_prune():
    r = np.random.default_rng(3)
    x = np.floor(256 * (r.normal(size=(2000, 4)) + 6 * r.integers(-3, 4, (2000, 1))))
    tree = V.BallTree(x)
    q = x[5]
    best = sorted(tree.search(q, -1, np.arange(2000), 5, -np.inf), reverse=True)
    scores = x @ q
    assert [b[0] for b in best] == sorted(scores.astype(int).tolist(), reverse=True)[:5]
    assert tree.search(q, -1, np.arange(2000), 5, scores.max() + 1) == []
    bound = tree.centre @ q + np.sqrt(q @ q) * tree.radius
    for node, rows in enumerate(tree.rows):
        if rows is not None:
            assert scores[rows].max() <= bound[node] + 1e-3


def test_quantisation_bounds_hold():
    r = np.random.default_rng(4)
    a, b = r.normal(size=(50, 64)), r.normal(size=(60, 64)) * 3
    (qa, sa, na, ea), (qb, sb, nb, eb) = V.quantised(a), V.quantised(b)
    near = (qa.astype(int) @ qb.T.astype(int)) * sa[:, None] * sb
    error = na[:, None] * eb + ea[:, None] * (nb + eb)
    assert (np.abs(a @ b.T - near) <= error + 1e-12).all()


def test_top_k_leaves_out_what_doubles_cannot_score(spark):
    rows = some(n=60) + [(2000, [1e200] * 9), (2050, [-1e18] + [0.0] * 8), (2051, [1e5] * 9)]
    got = listed(V.exact_top_k(frame(spark, rows)))
    assert got == brute([r for r in rows if r[0] not in (2000, 2050)], 5, 50, whole, True)
