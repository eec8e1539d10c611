"""Exact top-k search by inner product with a table of distances to pivots.

For whole vectors q and x and any pivot p, |d(q,p) - d(x,p)| is at most d(q,x).
The largest of these lower bounds over many pivots caps the inner product, as
2 q.x = |q|^2 + |x|^2 - d(q,x)^2. Candidates are evaluated in the order of
their caps until no cap reaches the k-th best score, so none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldspan.llm.vectors import is_whole, matrix, sample, unpack, widths

PIVOTS = 48
SAMPLE = 2_048  # rows from which pivots are chosen and first thresholds taken
QUERY_BLOCK = 4_096
ROW_BLOCK = 65_536
EXACT = float(1 << 53)


def pivots_of(rows: np.ndarray, many: int) -> np.ndarray:
    """Rows far from each other: each next one is the farthest from those chosen."""
    if not len(rows):
        return rows
    chosen = [0]
    nearest = np.linalg.norm(rows - rows[0], axis=1)
    while len(chosen) < min(many, len(rows)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, np.linalg.norm(rows - rows[chosen[-1]], axis=1))
    return rows[chosen]


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each row to each pivot."""
    return np.stack([np.sqrt(np.square(rows - p).sum(1)) for p in pivots], 1) if len(rows) else np.zeros((0, len(pivots)))


def scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, exact also where doubles would round; limited to the range of a 64-bit integer."""
    if not rows.size or np.abs(rows).max() * max(1.0, np.abs(query).max()) * len(query) < EXACT:
        return (rows @ query).astype(np.int64)
    whole = np.array([[int(x) for x in r] for r in rows], object) @ np.array([int(x) for x in query], object)
    return np.array([max(-(1 << 63), min((1 << 63) - 1, x)) for x in whole], np.int64)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def eliminate(query: np.ndarray, floor: int | None, cap: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """The best ``k`` of ``rows`` (ids, scores), evaluated in the order of ``cap`` until it falls below the k-th score.

    ``floor`` is a score that k candidates are known to reach, if there is one.
    """
    left = np.arange(len(cap)) if floor is None else np.flatnonzero(cap >= floor)
    left = left[np.argsort(-cap[left], kind="stable")]
    found_ids, found, at, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 32
    while at < len(left) and not (len(found) == k and cap[left[at]] < found[-1]):
        part = left[at:at + step]
        at, step = at + step, step * 2
        found = np.concatenate([found, scores(rows[part], query)])
        found_ids = np.concatenate([found_ids, ids[part]])
        kept = _best(found, found_ids, k)
        found, found_ids = found[kept], found_ids[kept]
    return found_ids, found


def top_k(df: DataFrame, k: int, every: int, ident: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` best rows for each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all
    rows but those with the query's own id. A component x counts as
    floor(``scale`` * x). Ties go to the smaller id; with fewer candidates all
    are returned. Vectors meet those of their own length: each length has its
    own pivots. Vectors that are null, empty or hold a null or non-finite
    component take no part, nor do rows without id. Rows with the same id are
    separate candidates. Scores beyond 64 bits are set to the nearest 64-bit number.
    Other columns are not used; an empty table gives an empty result.
    """
    whole = df.where(F.col(ident).isNotNull() & is_whole(vector)) \
        .select(F.col(ident).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_v"))
    parts = [_found(whole.where(F.size("_v") == width), many, width, k, every, scale) for width, many in widths(whole, "_v").items()]
    if not parts:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = reduce(DataFrame.unionByName, parts)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _found(whole: DataFrame, many: int, width: int, k: int, every: int, scale: float) -> DataFrame:
    """For each query of one length its best rows within each block: ``query_id``, ``vec_id``, ``score``."""
    spark = whole.sparkSession
    seen = sample(whole, "_id", SAMPLE)
    seen_rows = np.floor(scale * matrix(seen["_v"])).reshape(len(seen), width)
    seen_ids = seen["_id"].to_numpy(np.int64)
    pivots = pivots_of(seen_rows, PIVOTS)

    def indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["_id"].to_numpy(np.int64)
            rows = np.floor(scale * matrix(batch["_v"])).reshape(len(ids), width)
            far = distances(rows, pivots)
            floors = []
            for i, q in zip(ids, rows):  # the k-th best of the sample, for queries
                own = scores(seen_rows[seen_ids != i], q) if i % every == 0 else []
                floors.append(int(np.partition(own, -k)[-k]) if len(own) >= k else None)
            yield pd.DataFrame({"_id": ids, "_x": [r.tobytes() for r in rows], "_far": [d.tobytes() for d in far],
                                "_floor": pd.array(floors, "Int64")})

    index = whole.mapInPandas(indexed, "_id long, _x binary, _far binary, _floor long")
    is_query = F.col("_id") % every == 0
    # The stated queries meet all rows in blocks: every block of rows with every block of queries. A block of rows is
    # as large as memory allows, or small enough to give each shuffle partition two.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row_blocks = max(1, -(-many // min(ROW_BLOCK, max(1024, many // (2 * tasks)))))
    query_blocks = max(1, -(-(many // every + 1) // QUERY_BLOCK))
    block = lambda n: F.pmod(F.xxhash64("_id"), F.lit(n)).cast("int")
    queries = index.where(is_query).withColumn("_q", block(query_blocks)).withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    rows = index.drop("_floor").withColumn("_c", block(row_blocks)).withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def cell(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(there):
            ids, x, far = there["_id"].to_numpy(np.int64), unpack(there["_x"], np.float64, width), unpack(there["_far"], np.float64, len(pivots))
            q_ids, q, q_far = asked["_id"].to_numpy(np.int64), unpack(asked["_x"], np.float64, width), unpack(asked["_far"], np.float64, len(pivots))
            norms = np.square(x).sum(1)
            floors = [None if pd.isna(f) else int(f) for f in asked["_floor"]]
            step = max(1, (1 << 21) // len(ids))  # bounds the table of lower bounds
            for at in range(0, len(q), step):
                part = slice(at, at + step)
                low = np.zeros((len(q[part]), len(ids)))
                for p in range(len(pivots)):
                    np.maximum(low, np.abs(q_far[part, p, None] - far[None, :, p]), out=low)
                lengths = np.square(q[part]).sum(1)[:, None] + norms[None, :]
                caps = (lengths - np.square(low)) / 2 + 1e-9 * lengths + 1  # room for rounding
                for i, cap in enumerate(caps):
                    cap[ids == q_ids[at + i]] = -np.inf
                    own = cap > -np.inf
                    got, score = eliminate(q[at + i], floors[at + i], cap[own], x[own], ids[own], k)
                    out += [(q_ids[at + i], a, b) for a, b in zip(got, score)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return queries.groupBy("_c", "_q").cogroup(rows.groupBy("_c", "_q")).applyInPandas(cell, "query_id long, vec_id long, score long")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
