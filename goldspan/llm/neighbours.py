"""Near copies among vectors, found by a forest of random-projection trees.

A tree splits a label's vectors again and again by a random direction, at about
the median. Vectors within a margin of the split go to both sides (spill), so a
close pair is rarely parted; several trees with other directions find it in
another. Pairs are compared within leaves only and verified exactly.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldspan.llm.graph import components
from goldspan.llm.vectors import is_whole, matrix, sample, unpack, widths
from goldspan.session import stored

TREES = 6
LEAF = 400  # rows of the largest label that a leaf aims at
SAMPLE = 20_000  # rows from which the splits are fitted
LEAST_FIT = 24  # sample rows of a node from which a median is taken
SPILL = 0.8  # margin of a split, in standard deviations of a pair's difference at the threshold
BLOCK = 2_048  # rows of a leaf that one task compares with as many others


class Forest:
    """Directions shared by a tree's levels; thresholds per label and node, from the sample as far as it reaches."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, depth: int, width: int, least: float, seed: int = 7):
        self.depth = depth
        rng = np.random.default_rng(seed)
        way = rng.normal(size=(TREES, width, max(depth, 1)))
        self.way = way / np.linalg.norm(way, axis=1, keepdims=True)
        self.margin = SPILL * math.sqrt(max(0.0, 2 - 2 * least) / max(width, 1))
        self.splits: dict[tuple[int, int, int], float] = {}  # label, tree, node (root 1, children 2n and 2n + 1)
        self.centre: dict[tuple[int, int, int], np.ndarray] = {}  # where the sample ends: its last mean
        for label in np.unique(labels) if depth else []:
            own = rows[labels == label]
            for tree in range(TREES):
                self._fit(own, own @ self.way[tree], int(label), tree, 1, 0, own.mean(0))

    def _fit(self, rows, projected, label, tree, node, level, mean) -> None:
        if level == self.depth:
            return
        if len(rows) < LEAST_FIT:
            self.centre[label, tree, node] = mean
            return
        mean = rows.mean(0)
        split = float(np.median(projected[:, level]))
        self.splits[label, tree, node] = split
        for side, part in ((0, projected[:, level] <= split), (1, projected[:, level] > split)):
            self._fit(rows[part], projected[part], label, tree, 2 * node + side, level + 1, mean)

    def leaves(self, rows: np.ndarray, label: int, tree: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves of the tree with the rows in them; a row near splits is in several."""
        projected = rows @ self.way[tree]
        waiting = [(1, 0, np.arange(len(rows)), np.zeros(rows.shape[1]))]
        while waiting:
            node, level, at, centre = waiting.pop()
            if level == self.depth or not len(at):
                yield node, at
                continue
            centre = self.centre.get((label, tree, node), centre)
            split = self.splits.get((label, tree, node))
            if split is None:  # beyond the sample: split at its last mean
                split = float(centre @ self.way[tree][:, level])
            value = projected[at, level]
            waiting.append((2 * node, level + 1, at[value <= split + self.margin], centre))
            waiting.append((2 * node + 1, level + 1, at[value >= split - self.margin], centre))


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def local_components(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The least id of each row's component under the symmetric table ``linked``."""
    label = ids.copy()
    far = np.iinfo(np.int64).max
    while True:
        now = label.copy()
        for at in range(0, len(ids), 256):
            part = np.where(linked[at:at + 256], label[None, :], far).min(1)
            now[at:at + 256] = np.minimum(label[at:at + 256], part)
        if (now == label).all():
            return label
        label = now


def near_copies(df: DataFrame, least: float, ident: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept``: one row per row of ``df``.

    Only vectors with equal labels that are not null are compared, by cosine in
    double precision; pairs with cosine of at least ``least`` link. Vectors meet
    those of their own length: each length has its own forest. Vectors that are
    null, zero, empty or hold a null or non-finite component link with nothing,
    nor do rows without id. Equal vectors of a label are one class, compared once, so repeated
    rows are copies of each other; rows that share an id but not the vector each
    have the links of their own vector. ``n_links`` counts other rows linked directly, each once,
    however many leaves hold the pair. ``component_id`` is the least id
    reachable, ``kept`` marks the row that has it. An empty table gives an empty
    result; other columns are not used.

    Links found are exact; a pair that every tree parts is missed (see README
    for the measured recall). A leaf of any size is compared whole, in blocks.
    """
    rows = df.select(F.col(ident).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_v"), F.col(label).cast("long").alias("_label"))
    usable = is_whole("_v") & F.col("_id").isNotNull() & F.col("_label").isNotNull() & F.exists("_v", lambda x: x != 0)
    alone = rows.where(~F.coalesce(usable, F.lit(False))).select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    parts = [_linked(rows.where(usable & (F.size("_v") == width)), width, least) for width in widths(rows.where(usable), "_v")]
    return reduce(DataFrame.unionByName, parts, alone).select(
        F.col("_id").alias("vec_id"), "n_links", "component_id", (F.col("_id") == F.col("component_id")).alias("kept"))


def _linked(rows: DataFrame, width: int, least: float) -> DataFrame:
    """``_id``, ``n_links``, ``component_id`` of vectors of one length."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = [np.asarray(v, np.float64) + 0.0 for v in batch["_v"]]  # -0.0 is 0.0
            packed = [p.tobytes() for p in packed]
            yield pd.DataFrame({"_id": batch["_id"], "_label": batch["_label"], "_x": packed,
                                "_key": [hashlib.blake2b(p, digest_size=16).digest() for p in packed]})

    members = stored(rows.mapInPandas(keyed, "_id long, _label long, _x binary, _key binary"), "vectors")
    # a crowded vector becomes one row in each task before the shuffle
    classes = stored(members.groupBy("_label", "_key").agg(
        F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_n"), F.first("_x").alias("_x")), "classes")
    most = classes.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    depth = max(0, math.ceil(math.log2(max(1, most) / LEAF)))
    seen = sample(classes.select("_id", "_label", "_x"), "_id", SAMPLE)
    forest = Forest(unit(unpack(seen["_x"], np.float64, width)) if len(seen) else np.zeros((0, width)),
                    seen["_label"].to_numpy(np.int64), depth, width, least)

    def planted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = unit(unpack(batch["_x"], np.float64, width))
            labels = batch["_label"].to_numpy(np.int64)
            codes: list[list[int]] = [[] for _ in range(len(batch))]
            for own in np.unique(labels):
                at = np.flatnonzero(labels == own)
                for tree in range(TREES):
                    for leaf, inside in forest.leaves(x[at], int(own), tree):
                        for i in at[inside]:
                            codes[i].append(tree << 48 | leaf)
            yield batch.assign(_codes=[np.sort(np.array(c, np.int64)) for c in codes])

    placed = stored(classes.mapInPandas(planted, "_label long, _key binary, _id long, _n long, _x binary, _codes array<long>"), "leaves")
    entries = placed.withColumn("_leaf", F.explode("_codes"))
    # a leaf beyond a block is cut, and every two of its blocks meet in a task of their own
    crowded = entries.groupBy("_label", "_leaf").agg(F.count(F.lit(1)).alias("_rows"))
    blocks = F.ceil(F.col("_rows") / BLOCK).cast("int")
    cells = entries.join(crowded, ["_label", "_leaf"]).withColumn("_blocks", blocks) \
        .withColumn("_own", F.pmod(F.xxhash64("_id"), F.col("_blocks")).cast("int")) \
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))) \
        .withColumns({"_a": F.least("_own", "_other"), "_b": F.greatest("_own", "_other")}) \
        .select("_label", "_leaf", "_a", "_b", "_own", "_id", "_n", "_x", "_codes")

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("_id", ignore_index=True)
        leaf, ids, many = int(cell["_leaf"].iloc[0]), cell["_id"].to_numpy(np.int64), cell["_n"].to_numpy(np.int64)
        rows_ = unpack(cell["_x"], np.float64, width)
        x = unit(rows_)
        linked = np.zeros((len(ids), len(ids)), bool)
        for at in range(0, len(ids), 256):
            linked[at:at + 256] = x[at:at + 256] @ x.T >= least
        np.fill_diagonal(linked, False)
        a, b = int(cell["_a"].iloc[0]), int(cell["_b"].iloc[0])
        own = cell["_own"].to_numpy()
        if a != b:  # pairs within a block belong to that block's own task
            linked &= own[:, None] != own[None, :]
        linked |= linked.T
        label_ = local_components(linked, ids)
        # a pair counts in the first leaf that holds both
        holders: dict[int, list[int]] = {}
        for i, codes in enumerate(cell["_codes"]):
            for code in codes:
                if code >= leaf:
                    break
                holders.setdefault(code, []).append(i)
        for at in holders.values():
            if len(at) > 1:
                linked[np.ix_(at, at)] = False
        return pd.DataFrame({"_id": ids, "_least": label_, "_links": linked @ many})

    found = stored(cells.groupBy("_label", "_leaf", "_a", "_b").applyInPandas(compare, "_id long, _least long, _links long")
                   .where("_links > 0 OR _least <> _id"), "found")
    counts = found.groupBy("_id").agg(F.sum("_links").alias("_links"))
    of_classes = components(found, "_id", "_least")
    per_class = classes.select("_label", "_key", F.col("_id").alias("_class"), "_n") \
        .join(counts.withColumnRenamed("_id", "_class"), "_class", "left") \
        .join(of_classes.select(F.col("node").alias("_class"), "component"), "_class", "left") \
        .select("_label", "_key", (F.coalesce("_links", F.lit(0)) + F.col("_n") - 1).alias("n_links"),
                F.coalesce("component", "_class").alias("component_id"))
    return members.select("_id", "_label", "_key").join(per_class, ["_label", "_key"]).select("_id", "n_links", "component_id")


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r(vec_id, reached) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON l.a = r.reached),
c AS (SELECT vec_id, min(reached) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN n USING (vec_id) JOIN c USING (vec_id)
"""
