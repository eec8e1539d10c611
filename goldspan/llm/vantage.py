"""Nearest vectors by inner product through vantage-point trees, one for each shard of the rows.

Rows are scaled so that the longest has length one and get one more component that gives all of them length one; a query
gets a zero there. Then d(q, x)^2 = 2 - 2 q.x / (|q| longest): the nearest rows are those with the largest inner products.
A tree halves its rows by their distance to a vantage point and keeps the span of distances of both halves. With the
distance of a query to the point, the triangle inequality gives a least distance of each half. A half is skipped when
``factor`` times that bound is beyond the k-th distance found: with factor one nothing is missed, with more less is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldspan.llm.vectors import is_whole
from goldspan.session import stored

FACTOR = 1.5  # found 0.92 of the neighbours or more of all kinds of vectors that were tried; see README
LEAF = 32
SHARD = 16_384  # rows of a tree at most, about
QUERY_BLOCK = 2_048
SAMPLE = 2_048  # rows that give the queries their first k-th distance
ROUNDING = 1e-6  # distances lie between 0 and 2


class Tree:
    """A vantage-point tree of rows of length one, halved by rank, so that equal rows do no harm.

    ``order``: the rows as they lie in the leaves. By node, level by level: ``points``, where in that order the vantage
    point lies, and ``spans``, the least and greatest distance to it in both halves.
    """

    def __init__(self, order: np.ndarray, points: np.ndarray, spans: np.ndarray):
        self.order, self.points, self.spans = order, points, spans
        self.depth = (len(points) + 1).bit_length() - 1
        self.edges = _edges(len(order), self.depth)

    @classmethod
    def of(cls, rows: np.ndarray) -> Tree:
        many = len(rows)
        order, points, spans = np.arange(many), [], []
        for level in range((many // LEAF).bit_length() - 1 if many >= LEAF else 0):
            edges = _edges(many, level)
            own = np.repeat(np.arange(1 << level), np.diff(edges))
            # a row far from another one of the segment tells more rows apart than one in the middle
            away = _far(rows[order], rows[order[edges[:-1]]][own])
            point = order[np.lexsort((away, own))[edges[1:] - 1]]
            away = _far(rows[order], rows[point][own])
            by = np.lexsort((away, own))
            order, away, halves = order[by], away[by], _edges(many, level + 1)
            points.append(point)
            spans.append(np.stack([away[halves[:-1]], away[halves[1:] - 1]], 1))
        place = np.argsort(order)
        return cls(order, place[np.concatenate([np.zeros(0, int), *points])], np.concatenate([np.zeros((0, 2)), *spans]))

    def bounds(self, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """For each query and leaf a distance that no row of the leaf falls below. ``rows`` lie in the tree's order."""
        found = np.zeros((len(queries), 1))
        for level in range(self.depth):
            nodes = slice((1 << level) - 1, (2 << level) - 1)
            away = np.sqrt(np.maximum(0.0, 2 - 2 * queries @ rows[self.points[nodes]].T)).repeat(2, axis=1)
            low, high = self.spans[2 * nodes.start:2 * nodes.stop].T
            found = np.maximum(found.repeat(2, axis=1), np.maximum(away - high, low - away))
        return found


def _edges(many: int, depth: int) -> np.ndarray:
    """Where the 2^depth segments of a level start, and the end."""
    return many * np.arange((1 << depth) + 1) >> depth


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(a - b).sum(1))


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in doubles; equal rows get equal ones wherever they stand."""
    return (rows * query).sum(1)


def lifted(rows: np.ndarray, longest: float) -> np.ndarray:
    """Rows as the tree sees them: at most as long as ``longest``, which becomes one."""
    scaled = rows / longest
    return np.column_stack([scaled, np.sqrt(np.maximum(0.0, 1 - np.square(scaled).sum(1)))])


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def visit(tree: Tree, rows: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, bound: np.ndarray, reach: float,
          limit: float, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """The best ``k`` rows for a query (ids, inner products): leaves by rising bound until ``factor`` times the bound is
    beyond the k-th distance. ``limit``: an inner product that k rows are known to reach. ``reach``: |q| times the longest
    row. ``rows`` and ``ids`` lie in the tree's order."""
    found, found_ids = np.zeros(0), np.zeros(0, np.int64)
    turn, at, step = np.argsort(bound, kind="stable"), 0, 2
    bound = factor * (bound - ROUNDING)
    while at < len(turn):
        far = np.sqrt(max(0.0, 2 - 2 * limit / reach)) if limit > -np.inf else np.inf
        part = turn[at:at + step]
        part = part[bound[part] <= far]
        if not len(part):
            break
        at, step = at + step, step * 2
        here = np.concatenate([np.arange(tree.edges[i], tree.edges[i + 1]) for i in part])
        here = here[ids[here] != own]
        score = products(rows[here], query)
        near = score >= limit
        found, found_ids = np.concatenate([found, score[near]]), np.concatenate([found_ids, ids[here][near]])
        best = np.lexsort((found_ids, -found))[:k]
        found, found_ids = found[best], found_ids[best]
        if len(found) == k:
            limit = max(limit, found[-1])
    return found_ids, found


def _usable(df: DataFrame, ident: str, vector: str) -> DataFrame:
    """Rows that take part: ``_id``, ``_v`` in doubles, ``_width``, and ``_length`` of the vector."""
    value = F.transform(F.col(vector).cast("array<double>"), lambda x: x)
    found = df.where(F.col(ident).isNotNull() & is_whole(vector)).select(F.col(ident).cast("long").alias("_id"), value.alias("_v"), F.size(vector).alias("_width"))
    most = F.array_max(F.transform("_v", lambda x: F.abs(x)))
    found = found.withColumn("_most", most).where("_most > 0")
    square = F.aggregate("_v", F.lit(0.0), lambda a, x: a + (x / F.col("_most")) * (x / F.col("_most")))
    return found.withColumn("_length", F.col("_most") * F.sqrt(square)).drop("_most")


def _matrix(blobs, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), float).reshape(-1, width)


INDEX = "width int, shard int, longest double, ids binary, rows binary, points binary, spans binary"


def build(df: DataFrame, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The index: a row for each shard of the rows of a length of vectors, with its tree; stored.

    Rows without id, and vectors that are null, empty, zero or hold null or non-finite components are left out; all others
    are in. Rows are dealt in turn, so repeated ones spread evenly. An empty table gives an empty index.
    """
    whole = _usable(df, ident, vector)
    found = whole.groupBy("_width").agg(F.count(F.lit(1)).alias("many"), F.max("_length").alias("longest")).collect()
    shards = {r["_width"]: -(-r["many"] // SHARD) for r in found}
    longest = {r["_width"]: r["longest"] for r in found}

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn = None
        for batch in batches:
            if turn is None and len(batch):
                turn = int(batch["_id"].iloc[0])
            yield pd.DataFrame({"width": batch["_width"], "shard": [(turn + i) % shards[w] for i, w in enumerate(batch["_width"])],
                                "id": batch["_id"], "row": [np.asarray(v, float).tobytes() for v in batch["_v"]]})
            turn = (turn or 0) + len(batch)

    dealt = stored(whole.mapInPandas(deal, "width int, shard int, id long, row binary"), "vantage-rows")

    def plant(there: pd.DataFrame) -> pd.DataFrame:
        width = int(there["width"].iloc[0])
        ids, rows = there["id"].to_numpy(np.int64), _matrix(there["row"], width)
        tree = Tree.of(lifted(rows, longest[width]))
        return pd.DataFrame([(width, there["shard"].iloc[0], longest[width], ids[tree.order].tobytes(), rows[tree.order].tobytes(),
                              tree.points.tobytes(), tree.spans.tobytes())], columns=[f.split()[0] for f in INDEX.split(", ")])

    return stored(dealt.groupBy("width", "shard").applyInPandas(plant, INDEX), "vantage-trees")


def nearest(df: DataFrame, k: int = 20, every: int = 20, factor: float = FACTOR, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` rows found with the largest inner products.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but those with the query's own id,
    all of them with fewer than ``k``. Scores are inner products in doubles; ties go to the smaller id. With ``factor`` 1
    nothing is missed (short of differences of distance below ROUNDING); a greater one reads less and may miss some.

    Rows without id and vectors that are null, empty, zero or hold null or non-finite components take no part; vectors
    meet those of their own length. Of rows that share a query's id the least vector asks; as candidates each counts.
    Other columns are not used; an empty table gives an empty result.
    """
    index = build(df, ident, vector)
    shards = {r[0]: r[1] for r in index.groupBy("width").agg(F.max("shard") + 1).collect()}
    spark = df.sparkSession
    if not shards:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    whole = _usable(df, ident, vector)
    one_in = 1 + max(shards.values()) * SHARD // SAMPLE
    seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    some = whole.where(F.pmod(F.xxhash64("_id", "_v"), F.lit(one_in)) == 0).select("_id", "_v", "_width").limit(2 * SAMPLE).collect()
    for width in shards:
        own = [r for r in some if r["_width"] == width]
        seen[width] = np.array([r["_id"] for r in own], np.int64), np.array([r["_v"] for r in own], float).reshape(len(own), width)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            limits = []
            for own, width, v in zip(batch["query_id"], batch["width"], batch["_v"]):
                ids, rows = seen[width]
                score = products(rows[ids != own], np.asarray(v, float))
                limits.append(float(np.partition(score, -k)[-k]) if len(score) >= k else -np.inf)
            yield batch.drop(columns="_v").assign(row=[np.asarray(v, float).tobytes() for v in batch["_v"]], limit=limits)

    asked = whole.where(F.col("_id") % every == 0).groupBy(F.col("_id").alias("query_id")).agg(F.min(F.struct("_v", "_width", "_length")).alias("_q")) \
        .select("query_id", F.col("_q._width").alias("width"), F.col("_q._length").alias("length"), "_q._v")
    asked = stored(asked.mapInPandas(ask, "query_id long, width int, length double, row binary, limit double"), "vantage-queries")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    of_width = F.element_at(F.create_map(*(F.lit(x) for pair in shards.items() for x in pair)), F.col("width"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")) \
        .withColumn("shard", F.explode(F.sequence(F.lit(0), of_width - 1)))
    trees = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(queries: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        out = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0),)]
        if len(queries) and len(there):
            node = there.iloc[0]
            width, longest = int(node["width"]), float(node["longest"])
            ids, rows = np.frombuffer(node["ids"], np.int64), _matrix([node["rows"]], width)
            tree = Tree(np.arange(len(ids)), np.frombuffer(node["points"], np.int64), np.frombuffer(node["spans"], float).reshape(-1, 2))
            asked, length = _matrix(queries["row"], width), queries["length"].to_numpy(float)
            unit = np.column_stack([asked / length[:, None], np.zeros(len(asked))])
            bounds = tree.bounds(lifted(rows, longest), unit)
            for i, (own, limit) in enumerate(zip(queries["query_id"].tolist(), queries["limit"].tolist())):
                found, score = visit(tree, rows, ids, asked[i], own, bounds[i], length[i] * longest, limit, k, factor)
                out.append((np.full(len(found), own), found, score))
        return pd.DataFrame({name: np.concatenate([x[i] for x in out]) for i, name in enumerate(("query_id", "vec_id", "score"))})

    key = ("width", "shard", "block")
    found = asked.groupBy(*key).cogroup(trees.groupBy(*key)).applyInPandas(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
