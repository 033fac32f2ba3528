import numpy as np

from millrace.llm import embeddings


def brute(rows):
    """Links and components of (id, vector) pairs, by comparing all of them."""
    def ok(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    near = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(n):
            u, v = rows[a][1], rows[b][1]
            if a != b and ok(u) and ok(v) and len(u) == len(v):
                u, v = np.array(u, float), np.array(v, float)
                near[a, b] = u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.9
    label = list(range(n))
    for _ in range(n):
        label = [min([label[a], *(label[b] for b in np.flatnonzero(near[a]))]) for a in range(n)]
    name = {g: min((rows[a][0] for a in range(n) if label[a] == g and rows[a][0] is not None), default=None) for g in label}
    return sorted(((i, int(near[a].sum()), name[label[a]] if i is not None else None, i == name[label[a]] or i is None)
                   for a, (i, _) in enumerate(rows)), key=repr)


def got(spark, rows):
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, kept string")
    return sorted((tuple(r) for r in embeddings.near_vectors(frame).collect()), key=repr)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 0.0]), (3, [1.0, 0.0]), (9, [1.0, 0.01]), (1, None), (2, []), (4, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (10, [1.0, 0.0, 0.0]), (11, [-1.0, 0.0]), (12, [0.0, 2.0]), (None, [0.0, 1.0])]
    assert got(spark, rows) == brute(rows)


def test_components_of_any_size(spark):
    rows = [(1, [1e-200, 0.0]), (2, [0.0, 1e-200]), (3, [1e200, 0.0]), (4, [1e200, 1e200]), (5, [1.0, 0.0]), (6, [1e-300, 1e-301]),
            (7, [5e-324, 0.0]), (8, [-1e300, 0.0]), (9, [0.0, 1e308])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    unit = [(i, [x / max(map(abs, v)) for x in v]) for i, v in rows]
    assert sorted((tuple(r) for r in embeddings.near_vectors(frame).collect()), key=repr) == brute(unit)


def test_empty(spark):
    assert got(spark, []) == []


def test_dense_leaves_in_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "LEAF_ROWS", 16)
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 20)
    draw = np.random.default_rng(3)
    centre = draw.standard_normal(16)
    hot = centre + 0.22 * draw.standard_normal((70, 16))
    rest = draw.standard_normal((90, 16))
    near = rest[:40] + 0.2 * draw.standard_normal((40, 16))
    rows = [(n, [float(np.float32(x)) for x in v]) for n, v in enumerate(np.concatenate([hot, rest, near, near[:5]]))]
    want, have = brute(rows), got(spark, rows)
    found, there = sum(r[1] for r in have), sum(r[1] for r in want)
    assert 0.97 * there <= found <= there
