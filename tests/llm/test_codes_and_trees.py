"""Vector codes against plain arithmetic on Python integers; tree search against all inner products."""

import hashlib
import math
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from goldspan.llm import codes, vantage  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def vectors(many=150, width=32, seed=4, spread=1.0):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=width) * spread], i % 3 if i % 7 else None, "x") for i in range(many)]
    odd = [None, [math.nan] * width, [None] + [1.0] * (width - 1), [0.0] * width, [math.inf] * width]
    rows += [(many + i, v, 1, None) for i, v in enumerate(odd)]
    same = [(1000 + i, rows[3][1], 2, "y") for i in range(60)]
    return rows + same + [(1000, rows[4][1], 1, "y"), (None, rows[5][1], None, "z")]


def whole(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def coded(rows, parts=16, entries=64, rounds=2):
    """All entries compared, with Python integers."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label, _ in rows if whole(v) and len(v) >= parts and len(v) % parts == 0]
    if not kept:
        return []
    size = len(kept[0][1]) // parts
    cut = [[v[p * size:(p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda j: (kept[j][0] is None, kept[j][0] or 0, kept[j][1]))
    books = [[cut[j][p] for j in order[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(row[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)] for row in cut]
    for _ in range(rounds):
        own = assign()
        for p in range(parts):
            members = defaultdict(list)
            for row, found in zip(cut, own):
                members[found[p][1]].append(row[p])
            for k, m in members.items():
                books[p][k] = [sum(x) // len(m) for x in zip(*m)]
    own = assign()
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in found) for found in own]
    by_label = defaultdict(int)
    for (_, _, label), e in zip(kept, errors):
        by_label[label] += e
    clip = lambda x: min(x, (1 << 63) - 1)
    return [(i, "".join(f"{k:02x}" for _, k in found), clip(e), clip(by_label[label]), digest) for (i, _, label), found, e in zip(kept, own, errors)]


def key(r):
    return tuple((x is None, x) for x in r[:3])


@pytest.mark.parametrize("spread", [1.0, 0.001, 1e12])
def test_codes(spark, spread):
    rows = vectors(spread=spread)
    got = [tuple(r) for r in codes.codes(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS error", "2 AS _width")).collect()]
    assert sorted(got, key=key) == sorted(coded(rows), key=key)


def test_one_large_vector_among_small_ones(spark):
    single = lambda v: [float(np.float32(x)) for x in v]
    rows = [*vectors(40), (2000, single([3.0e38] + [-1.0e30] * 31), 1, "x"), (-1, single([2.0 ** 40 + 2.0 ** 18] * 32), 1, "x")]
    got = [tuple(r) for r in codes.codes(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=key) == sorted(coded(rows), key=key)


def test_codes_by_length(spark):
    """Each length has its own codebooks; lengths that cannot be cut stay without."""
    short, long = vectors(30, 16), [(5000 + i, v, label, c) for i, (_, v, label, c) in enumerate(vectors(20, 48, 9))]
    odd = [(9000, [1.0] * 17, 7, "x"), (9001, [], 7, "x")]
    got = [tuple(r) for r in codes.codes(spark.createDataFrame(short + long + odd, SCHEMA)).collect()]
    want = [r[:3] + (r[4],) for r in coded(short) + coded(long)] + [(9000, None, None, None), (9001, None, None, None)]
    assert sorted((r[:3] + (r[4],) for r in got), key=key) == sorted(want, key=key)
    assert all(r[3] is not None for r in got if r[1] is not None)
    labels = defaultdict(int)
    for r, label in [(r, {x[0]: x[2] for x in short + long if x[0] is not None}.get(r[0])) for r in got if r[0] is not None and r[2] is not None]:
        labels[label] += r[2]
    assert all(r[3] is None for r in got if r[0] in (9000, 9001)) and len(labels) > 2
    assert codes.codes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cells_keep_every_nearest_entry():
    """Also for parts at the borders of cells, entries at equal distance, and a memo that starts anew."""
    rng = np.random.default_rng(0)
    book = rng.integers(-9, 9, (40, 3)).astype(object)
    cells = codes.Cells(book)
    grid = np.stack(np.meshgrid(*[np.arange(-15, 15)] * 3), -1).reshape(-1, 3)
    far = np.square(grid[:, None].astype(int) - book[None].astype(int)).sum(2)
    assert len(cells.memo) == 0
    for rows in np.array_split(grid, 7):
        index, away = cells.nearest(rows)
        mine = far[[int(np.flatnonzero((grid == r).all(1))[0]) for r in rows[:50]]]
        assert (index[:50] == mine.argmin(1)).all() and (away[:50] == mine.min(1)).all()
    index, away = cells.nearest(grid)
    assert (index == far.argmin(1)).all() and (away == far.min(1)).all()
    assert np.mean([len(x) for x in cells.memo.values()]) < 20


def best(rows, k, every):
    kept = [(i, np.array(v, float)) for i, v, _, _ in rows if i is not None and whole(v) and any(v)]
    asking = {}
    for i, v in kept:
        if i % every == 0 and (i not in asking or (list(v) < list(asking[i]) if len(v) == len(asking[i]) else list(v) < list(asking[i]))):
            asking[i] = v
    out = []
    for q, v in asking.items():
        found = sorted((-float((w * v).sum()), i) for i, w in kept if i != q and len(w) == len(v))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def test_factor_one_is_exact(spark, monkeypatch):
    monkeypatch.setattr(vantage, "SHARD", 70)
    monkeypatch.setattr(vantage, "LEAF", 4)
    monkeypatch.setattr(vantage, "QUERY_BLOCK", 3)
    rows = [(i, [float(np.float32(x * (1 + (i or 0) % 5))) for x in v] if v and whole(v) else v, label, c) for i, v, label, c in vectors(300, 6)]
    rows += [(20, rows[8][1], 0, "x"), (5000, [1.0, 2.0], 0, "x"), (5001, [1.0, 1.0], 0, "x"), (5002, [], 0, "x")]
    got = sorted(tuple(r) for r in vantage.nearest(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS shard", "2 AS row"), 7, 10, 1.0).collect())
    want = best(rows, 7, 10)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12)
    assert [r[2] for r in got if r[0] == 5000] == [5001]
    assert vantage.nearest(spark.createDataFrame(rows[:0], SCHEMA), 7, 10).count() == 0


def test_recall_of_a_greater_factor(spark, monkeypatch):
    monkeypatch.setattr(vantage, "SHARD", 1500)
    rng = np.random.default_rng(6)
    middle = rng.normal(size=(40, 64))
    rows = [(i, [float(x) for x in middle[i % 40] + rng.normal(size=64)], 0, "x") for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got, want = ({tuple(r[:3:2]) for r in vantage.nearest(df, 20, 20, f).collect()} for f in (vantage.FACTOR, 1.0))
    assert want == {(r[0], r[2]) for r in best([(i, [float(np.float32(x)) for x in v], 0, "x") for i, v, _, _ in rows], 20, 20)}
    assert len(got & want) >= 0.95 * len(want)


def test_a_tree_skips_leaves():
    """Rows in tight groups: a query near one group is told that the others are far; no bound is above the truth."""
    rng = np.random.default_rng(8)
    rows = np.repeat(rng.normal(size=(16, 8)), 64, 0) + rng.normal(size=(1024, 8)) * 0.01
    tall = vantage.lifted(rows, float(np.linalg.norm(rows, axis=1).max()))
    tree = vantage.Tree.of(tall)
    assert sorted(tree.order) == list(range(1024)) and tree.depth == 5
    query = np.append(rows[70] / np.linalg.norm(rows[70]), 0.0)[None]
    bound = tree.bounds(tall[tree.order], query)[0]
    away = np.linalg.norm(tall[tree.order] - query, axis=1)
    least = np.minimum.reduceat(away, tree.edges[:-1])
    assert (bound <= least + 1e-9).all() and (bound > np.partition(away, 20)[20]).sum() > 8
