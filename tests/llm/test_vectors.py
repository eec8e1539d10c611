"""Search and near copies of vectors against brute force."""

import itertools
import math
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from goldspan.llm import neighbours, search  # noqa: E402
from goldspan.llm.graph import components  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int, score double"


def vectors(many=230, width=12, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(many):
        v = rng.normal(size=width)
        if i % 4 == 1:
            v = np.array(rows[-1][1]) * (1.5 if i % 8 == 1 else 1) + rng.normal(size=width) * 0.05
        rows.append((i, [float(np.float32(x)) for x in v], i // 4 % 3, 0.0))
    odd = [None, [], [math.nan] * width, [None] + [1.0] * (width - 1), [0.0] * width, [math.inf] * width, [1.0] * (width - 1)]
    rows += [(many + i, v, 1, None) for i, v in enumerate(odd)]
    return [*rows, (900, rows[7][1], rows[7][2], 0.0), (950, rows[7][1], rows[7][2], 0.0), (951, rows[7][1], None, 0.0), (None, rows[7][1], 1, 0.0)]


def whole(v, width=12):
    return v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)


def test_top_k(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA)
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v, _, _ in rows if i is not None and whole(v)]
    want = []
    for q, v in usable:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)[:5]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in search.top_k(df, 5, 50).collect()) == sorted(want)
    assert search.top_k(df.limit(0), 5, 50).count() == 0
    few = search.top_k(df.where("vec_id in (0, 3)"), 5, 50).collect()
    assert [(r["query_id"], r["vec_id"]) for r in few] == [(0, 3)]


def test_large_components_are_scored_exactly():
    rows = np.array([[2.0 ** 40, 3.0], [1.0, 1.0]])
    assert search.scores(rows, np.array([2.0 ** 21, 1.0])).tolist() == [2 ** 61 + 3, 2 ** 21 + 1]


def test_near_copies(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 16)
    monkeypatch.setattr(neighbours, "BLOCK", 24)
    rows = vectors()
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in neighbours.near_copies(spark.createDataFrame(rows, SCHEMA), 0.98).collect()}
    usable = [(i, np.array(v, float), l) for i, v, l, _ in rows if i is not None and l is not None and whole(v) and any(v)]
    links, root = dict.fromkeys(got, 0), {i: i for i in got}

    def find(i):
        return i if root[i] == i else find(root[i])
    for (i, a, l), (j, b, m) in itertools.combinations(usable, 2):
        if l == m and a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.98:
            links[i] += 1
            links[j] += 1
            x, y = sorted((find(i), find(j)))
            root[y] = x
    assert sum(links.values()) > 60
    assert {i: g for i, g in got.items() if i is not None} == {i: (links[i], find(i), find(i) == i) for i in got if i is not None}
    assert neighbours.near_copies(spark.createDataFrame(rows, SCHEMA).limit(0), 0.98).count() == 0


def test_recall_of_the_forest(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 40)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(600, 64))
    near = base + rng.normal(size=base.shape) * 0.19
    rows = [(i, [float(x) for x in v], 0, 0.0) for i, v in enumerate(np.concatenate([base, near]).astype(np.float32))]
    got = sum(r["n_links"] for r in neighbours.near_copies(spark.createDataFrame(rows, SCHEMA), 0.98).collect())
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = int((x @ x.T >= 0.98).sum()) - len(x)
    assert want > 300 and got <= want and got >= 0.97 * want


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(60, 50), (50, 60), (70, 70), (None, 1)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 60: 50}


def test_vectors_of_each_length_meet(spark, monkeypatch):
    """One vector of another length at the least id, a second length with pairs of its own, and a lone one."""
    monkeypatch.setattr(neighbours, "LEAF", 16)
    rng = np.random.default_rng(1)
    plane = [(i, [1.0, float(np.float32(0.001 * i))], 0, 0.0) for i in range(1, 120)]
    space = [(i, [float(x) for x in rng.normal(size=3).astype(np.float32)], 0, 0.0) for i in (0, 200, 250, 300)] + [(301, [1.0, 2.0, 3.0], 1, 0.0), (302, [2.0, 4.0, 6.0], 1, 0.0)]
    rows = [*plane, *space, (400, [1.0] * 5, 0, 0.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v, _, _ in rows]
    want = []
    for q, v in usable:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q and len(w) == len(v))[:5]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in search.top_k(df, 5, 50).collect()) == sorted(want)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in neighbours.near_copies(df, 0.98).collect()}
    links = {i: [j for j, w, m, _ in rows if j != i and m == l and len(w) == len(v) and
                 np.dot(v, w) / math.sqrt(np.dot(v, v) * np.dot(w, w)) >= 0.98] for i, v, l, _ in rows}
    assert {i: n for i, (n, _) in got.items()} == {i: len(x) for i, x in links.items()}
    assert got[302] == (1, 301) and got[1][0] > 100 and got[400] == (0, 400)
