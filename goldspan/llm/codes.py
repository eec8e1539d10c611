"""Vectors as short codes: each part of a vector is named by the nearest entry of a codebook, found through memoised cells.

A part lies in a cell of a coarse grid. Over the whole box of a cell each entry has a least and a greatest distance; an
entry whose least distance is beyond another one's greatest is the nearest one nowhere in the box. What is left of the
codebook is kept for the cell, and a part is compared with those entries alone, so the result is that of comparing all.
All arithmetic is on integers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldspan.llm.vectors import is_whole
from goldspan.session import stored

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
CELLS = 4096  # cells wanted over the span of a codebook
KEPT = 1 << 17  # cells a memo holds before it starts anew
BLOCK = 2048  # new cells worked on at a time
GREATEST = (1 << 63) - 1
_LOW = 10 ** 18

Book = list[np.ndarray]  # for each part its entries: rows of Python integers


def integers(vector: np.ndarray, scale: int = SCALE) -> list[int]:
    """floor(scale * x) of doubles, without rounding where ``scale`` is a power of two."""
    return [math.floor(scale * x) if abs(x) < 2.0 ** 900 else scale * int(x) for x in vector.tolist()]


class Cells:
    """The nearest entries of one part's codebook, with a memo of what is left of it in each cell."""

    def __init__(self, entries: np.ndarray):
        self.exact = entries
        many, width = entries.shape
        self.most = math.isqrt((1 << 62) // (many * width)) // 2 - 1  # up to here 64 bits hold distance and index
        self.small = bool(entries.size) and max(abs(int(x)) for x in entries.ravel()) <= self.most
        if self.small:
            self.entries = entries.astype(np.int64)
            span = int(self.entries.max()) - int(self.entries.min()) + 1
            self.side = max(1, -(-span // max(1, int(CELLS ** (1 / width) + 1e-9))))
        self.memo: dict[bytes, np.ndarray] = {}

    def left(self, cells: np.ndarray) -> list[np.ndarray]:
        """For each cell the entries not dominated across its box, rising."""
        keys = [c.tobytes() for c in cells]
        new = [i for i, k in enumerate(keys) if k not in self.memo]
        if new and len(self.memo) + len(new) > KEPT:
            self.memo.clear()
            new = list(range(len(keys)))
        for at in range(0, len(new), BLOCK):
            part = new[at:at + BLOCK]
            low = np.zeros((len(part), len(self.entries)), np.int64)
            high = np.zeros_like(low)
            for place in range(cells.shape[1]):
                start = cells[part, place, None] * self.side
                below, above = start - self.entries[None, :, place], self.entries[None, :, place] - (start + self.side - 1)
                low += np.square(np.maximum(np.maximum(below, above), 0))
                high += np.square(np.maximum(np.abs(below), np.abs(above)))
            open_ = low <= high.min(1, keepdims=True)
            for i, row in zip(part, open_):
                self.memo[keys[i]] = np.flatnonzero(row).astype(np.int32)
        return [self.memo[k] for k in keys]

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of rows of 64-bit integers up to ``most``; ties to the lower index."""
        if not len(rows):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        many = len(self.entries)
        cells, own = _distinct(np.floor_divide(rows, self.side))
        lists = self.left(cells)
        size = np.array([len(x) for x in lists], np.int64)
        start = np.cumsum(size) - size
        end = np.cumsum(size[own])
        first = end - size[own]
        row = np.repeat(np.arange(len(rows)), size[own])
        entry = np.concatenate(lists)[start[own][row] + np.arange(len(row)) - first[row]]
        best = np.minimum.reduceat(np.square(rows[row] - self.entries[entry]).sum(1) * many + entry, first)
        return best % many, best // many

    def nearest_exactly(self, row: list[int]) -> tuple[int, int]:
        """The same for one row of integers of any size, over all entries."""
        far = [sum((x - y) ** 2 for x, y in zip(row, entry)) for entry in self.exact]
        return far.index(min(far)), min(far)


def _distinct(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and, for each row, which of them it is."""
    low = cells.min(0)
    width = [int(x) for x in cells.max(0) - low + 1]
    if math.prod(width) >= 1 << 62:
        found, own = np.unique(cells, axis=0, return_inverse=True)
        return found, own.ravel()
    code = np.zeros(len(cells), np.int64)
    for place, many in enumerate(width):
        code = code * many + (cells[:, place] - low[place])
    _, first, own = np.unique(code, return_index=True, return_inverse=True)
    return np.ascontiguousarray(cells[first]), own


def assigned(vectors: np.ndarray, cells: list[Cells], scale: int = SCALE) -> tuple[np.ndarray, list[int], dict[int, list[int]]]:
    """Entry of each part of rows of doubles, each row's summed distances, and the integers of rows too large for 64 bits."""
    codes = np.zeros((len(vectors), len(cells)), np.int64)
    errors = np.zeros(len(vectors), object)
    most = min(c.most if c.small else -1 for c in cells)
    with np.errstate(over="ignore"):
        whole = np.floor(scale * vectors)
    small = np.abs(whole).max(1, initial=0) <= most
    width = vectors.shape[1] // len(cells)
    rows = whole[small].astype(np.int64)
    for place, cell in enumerate(cells):
        if len(rows):
            codes[small, place], far = cell.nearest(rows[:, place * width:(place + 1) * width])
            errors[small] += far.astype(object)
    large = {int(i): integers(vectors[i], scale) for i in np.flatnonzero(~small)}
    for i, row in large.items():
        for place, cell in enumerate(cells):
            codes[i, place], far = cell.nearest_exactly(row[place * width:(place + 1) * width])
            errors[i] += far
    return codes, errors.tolist(), large


def _whole(df: DataFrame, ident: str, vector: str, *more: str) -> DataFrame:
    """Rows with a vector that is not null and has finite components; ``_width`` is its length."""
    return df.where(is_whole(vector) | (F.size(vector) == 0)).select(
        F.col(ident).alias("_id"), F.col(vector).cast("array<double>").alias("_v"), F.size(vector).alias("_width"),
        *(F.col(c).alias("_label") for c in more))


def _by_width(batch: pd.DataFrame, books: dict[int, object]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The places and vectors of a batch for each length that has a codebook."""
    for width in sorted(set(batch["_width"])):
        if width in books:
            at = np.flatnonzero(batch["_width"].to_numpy() == width)
            yield int(width), at, np.stack([np.asarray(v, float) for v in batch["_v"].iloc[at]])


SUMS = "width int, part int, entry int, place int, many long, high decimal(38,0), low decimal(38,0)"


def _updated(whole: DataFrame, books: dict[int, Book], parts: int, scale: int) -> dict[int, Book]:
    """Each entry replaced by the componentwise floor of the mean of the parts assigned to it; unused ones stay."""
    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = {w: [Cells(b) for b in book] for w, book in books.items()}
        sums = {w: np.zeros((parts, len(book[0]), w // parts), object) for w, book in books.items()}
        many = {w: np.zeros((parts, len(book[0])), np.int64) for w, book in books.items()}
        for batch in batches:
            for width, _, vectors in _by_width(batch, books):
                codes, _, large = assigned(vectors, cells[width], scale)
                size = width // parts
                small = np.ones(len(vectors), bool)
                small[list(large)] = False
                rows = np.floor(scale * vectors[small]).astype(np.int64)
                for part in range(parts):
                    added = np.zeros(sums[width].shape[1:], np.int64)
                    np.add.at(added, codes[small, part], rows[:, part * size:(part + 1) * size])
                    sums[width][part] += added
                    many[width][part] += np.bincount(codes[:, part], minlength=len(added))
                    for i, row in large.items():
                        sums[width][part, codes[i, part]] += np.array(row[part * size:(part + 1) * size], object)
        for width, found in sums.items():
            out = [(width, p, e, d, int(many[width][p, e]), *map(Decimal, divmod(int(found[p, e, d]), _LOW)))
                   for p in range(parts) for e in np.flatnonzero(many[width][p]).tolist() for d in range(width // parts)]
            if out:
                yield pd.DataFrame(out, columns=["width", "part", "entry", "place", "many", "high", "low"])

    added = whole.mapInPandas(add_up, SUMS).groupBy("width", "part", "entry", "place").agg(
        F.sum("many").alias("many"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    new = {w: [b.copy() for b in book] for w, book in books.items()}
    for r in added.collect():  # at most one row for each number of the codebooks
        new[r["width"]][r["part"]][r["entry"], r["place"]] = (int(r["high"]) * _LOW + int(r["low"])) // r["many"]
    return new


def train(df: DataFrame, ident: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
          rounds: int = ROUNDS, scale: int = SCALE) -> dict[int, Book]:
    """Codebooks for each length of vectors that can be cut into ``parts`` equal parts of at least one component.

    A component x counts as floor(``scale`` * x). They start as the parts of the ``entries`` vectors (all, if fewer) with
    the least ids of that length, ties by the vector, null ids last. Each round assigns every part to its nearest entry
    (ties to the lower index) and replaces each entry by the componentwise floor of its parts' mean. Vectors that are
    null or hold a null or non-finite component take no part; without any there are no codebooks.
    """
    whole = _whole(df, ident, vector).where((F.col("_width") >= parts) & (F.col("_width") % parts == 0))
    first = Window.partitionBy("_width").orderBy(F.asc_nulls_last("_id"), "_v")
    seeds = stored(whole.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") <= entries), "code-seeds")
    books: dict[int, Book] = {}
    for width in sorted(r[0] for r in seeds.select("_width").distinct().collect()):
        rows = [integers(np.asarray(r["_v"], float), scale) for r in seeds.where(F.col("_width") == width).orderBy("_nth").collect()]
        size = width // parts
        books[width] = [np.array([r[p * size:(p + 1) * size] for r in rows], object).reshape(len(rows), size) for p in range(parts)]
    for _ in range(rounds):
        if books:
            books = _updated(whole, books, parts, scale)
    return books


def digest(book: Book) -> str:
    """SHA-256 of all components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for part in book for x in part.ravel()).encode()).hexdigest()


def encode(df: DataFrame, books: dict[int, Book], ident: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """``_id``, ``_label``, ``_width``, ``code`` (two hex digits a part) and ``error`` (summed squared distances, at most
    2^63 - 1) of every row whose vector is not null and has finite components only; both null without a codebook."""
    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = {w: [Cells(b) for b in book] for w, book in books.items()}
        for batch in batches:
            code, error = np.full(len(batch), None, object), np.full(len(batch), None, object)
            for width, at, vectors in _by_width(batch, books):
                codes, far, _ = assigned(vectors, cells[width], scale)
                code[at] = [bytes(c).hex() for c in codes.astype(np.uint8)]
                error[at] = [min(x, GREATEST) for x in far]
            yield batch.drop(columns="_v").assign(code=code, error=pd.array(error, "Int64"))

    whole = _whole(df, ident, vector, label)
    kind = {f.name: f.dataType.simpleString() for f in whole.schema}
    return whole.mapInPandas(name, f"_id {kind['_id']}, _width int, _label {kind['_label']}, code string, error long")


def codes(df: DataFrame, ident: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` (errors summed over equal labels, nulls together, at most 2^63 - 1)
    and ``codebooks_sha256``, by codebooks trained on all rows.

    Rows whose vector is null or holds a null or non-finite component are left out. Each length of vectors has codebooks of
    its own; a length that cannot be cut into ``PARTS`` equal parts of at least one component gets null codes, errors and
    digests. With fewer vectors than ``ENTRIES`` the codebooks are shorter. Rows with the same id are coded each for
    itself, null ids too. Other columns are not used; an empty table gives an empty result.
    """
    books = train(df, ident, vector)
    coded = stored(encode(df, books, ident, vector, label), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    each = coded.groupBy("_label").agg(F.when(total > GREATEST, GREATEST).otherwise(total.cast("long")).alias("label_error")).toDF("_of", "label_error")
    digests = F.lit(None).cast("string")
    for width, book in books.items():
        digests = F.when(F.col("_width") == width, digest(book)).otherwise(digests)
    return coded.join(each, F.col("_label").eqNullSafe(F.col("_of"))).select(
        F.col("_id").alias("vec_id"), "code", "error", "label_error", digests.alias("codebooks_sha256"))


def _sql() -> str:
    """The same in SQL: the rounds written one after the other."""
    parts = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e,
    row_number() OVER (ORDER BY vec_id) AS nth
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT vec_id, label, nth, part, e[part * (len(e) // {PARTS}) + 1:(part + 1) * (len(e) // {PARTS})] AS x
  FROM v, (SELECT unnest(range({PARTS})) AS part)),
b0 AS MATERIALIZED (SELECT part, nth - 1 AS entry, x AS y FROM p WHERE nth <= {ENTRIES}),"""
    for i in range(ROUNDS + 1):
        parts += f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, label, part, entry, far, x FROM (
    SELECT p.*, entry, list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS far
    FROM p JOIN b{i} USING (part))
  QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY far, entry) = 1),"""
        if i < ROUNDS:
            parts += f"""
m{i} AS (
  SELECT part, entry, place, CAST(floor(CAST(sum(x[place]) AS DOUBLE) / count(*)) AS BIGINT) AS y
  FROM (SELECT part, entry, x, unnest(range(1, len(x) + 1)) AS place FROM a{i}) GROUP BY part, entry, place),
n{i} AS (SELECT part, entry, list(y ORDER BY place) AS y FROM m{i} GROUP BY part, entry),
b{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(n.y, b.y) AS y FROM b{i} b LEFT JOIN n{i} n USING (part, entry)),"""
    return parts + f"""
c AS (
  SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, entry)) FROM b{ROUNDS}) AS codebooks_sha256
FROM c
"""


SQL = _sql()
