"""Packing documents into token sequences of one size by best-two-fit.

Documents of equal length are alike to a packer, so it works on how many there
are of each length: at most ``capacity`` numbers, however large the corpus. One
*filling* (a bin's lengths) is made by filling greedily and then replacing the
smallest document by two that fit the widened gap more tightly; it is repeated
as often as the counts allow. Spark counts the lengths, numbers the pieces of
each length where they lie, and looks up each piece's place by that number.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldspan.llm.kept import kept
from goldspan.llm.vocabulary import PIECE, PLAIN, UnitMemo, Vocabulary, strides, vocabulary
from goldspan.session import stored

CHUNK = 16_384  # characters encoded at a time


class IdsByUnit:
    """The ids of texts as little-endian unsigned 32-bit numbers.

    Texts are encoded whole by a rank table with the same merges. Those with
    unusual characters or special strings go unit by unit, and the units that
    have them through the file's own library.
    """

    def __init__(self, words: Vocabulary):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        os.environ["RAYON_NUM_THREADS"] = "1"
        # the rank of a token is the order in which merges make it; single bytes come first
        order = sorted((i for i in words.id_of.values()), key=lambda i: (words.rank[i], i))
        self.id_of_rank = np.array(order, "<u4")
        self.ranked = tiktoken.Encoding("units", pat_str=PIECE.pattern, special_tokens={},
                                        mergeable_ranks={words.bytes_of[i]: r for r, i in enumerate(order)})
        self.words = words
        self.memo = UnitMemo(self.units)

    def units(self, units: list[str]) -> list[bytes]:
        by_rank, special, own = self.ranked.encode_ordinary, tuple(self.words.special), self.id_of_rank
        plain = [bool(PLAIN.fullmatch(u)) and not any(s in u for s in special) for u in units]
        rest = iter(self.words.library.encode_batch([u for u, p in zip(units, plain) if not p], add_special_tokens=False))
        return [own[by_rank(u)].tobytes() if p and u else np.array(next(rest).ids, "<u4").tobytes() if not p else b""
                for u, p in zip(units, plain)]

    def is_plain(self, text: str) -> bool:
        return bool(PLAIN.fullmatch(text)) and not any(s in text for s in self.words.special)

    def whole(self, text: str) -> bytes:
        """Of a plain text, some thousand characters at a time: cut where a single space opens a word, which begins a piece."""
        parts, at = [], 0
        while len(text) - at > CHUNK:
            end = text.find(" ", at + CHUNK)
            while 0 <= end and (text[end - 1].isspace() or text[end + 1:end + 2].isspace() or end + 1 == len(text)):
                end = text.find(" ", end + 1)
            if end < 0:
                break
            parts.append(text[at:end])
            at = end
        found = [self.ranked.encode_to_numpy(part, disallowed_special=()) for part in [*parts, text[at:]] if part]
        return self.id_of_rank[np.concatenate(found)].tobytes() if found else b""

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        plain = [self.is_plain(t) for t in texts]
        others = self.memo.values([t for t, p in zip(texts, plain) if not p])
        for text, p in zip(texts, plain):
            if p:
                yield self.whole(text)
            else:
                first, rest = next(others)
                yield first + b"".join(rest)


NUMBERS = {"_slab": "long", "_nth": "long"}


class Numbering:
    """Numbers the pieces of each length in a partition: ``_slab`` is the partition, ``_nth`` the number."""

    def __init__(self, capacity: int):
        self.seen = np.zeros(capacity + 1, np.int64)

    def added(self, pieces: pd.DataFrame) -> pd.DataFrame:
        sizes = pieces["length"].to_numpy(np.int64)
        nth = self.seen[sizes] + pieces.groupby("length").cumcount().to_numpy()
        self.seen += np.bincount(sizes, minlength=len(self.seen))
        return pieces.assign(_slab=TaskContext.get().partitionId(), _nth=nth)


def _numbered(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, T.LongType()) for n in NUMBERS)])


def cut_documents(df: DataFrame, path: str, capacity: int, end_id: int, id_column: str = "doc_id",
                  text: str = "text", keep_ids: bool = False, numbered: bool = False) -> DataFrame:
    """The pieces of each document: ``piece``, ``start``, ``length`` and ``ids_crc32`` beside ``id_column``.

    A document is the ids of its whole text (null: empty) and ``end_id``. Only
    those longer than ``capacity`` are cut, into pieces of ``capacity`` ids; the
    first piece is shorter where they do not come out even. ``keep_ids`` adds
    the ids themselves, ``numbered`` the columns that ``pack`` would add in a pass
    of its own. One narrow pass; other columns of ``df`` are left out.
    """
    fields = [T.StructField(id_column, df.schema[id_column].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType())]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType(), False)))
    schema = T.StructType(fields)
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbering = Numbering(capacity) if numbered else None
        coder = kept(("ids by unit", path), lambda: IdsByUnit(vocabulary(path)))
        for batch in batches:
            names, texts = batch[id_column].tolist(), batch[text].tolist()
            for a, b in strides(texts):
                rows = []
                for name, ids in zip(names[a:b], coder.encode([t or "" for t in texts[a:b]])):
                    ids += end
                    n = len(ids) // 4
                    at, size = 0, n % capacity or capacity
                    for piece in range(-(-n // capacity)):
                        part = ids[4 * at:4 * (at + size)]
                        rows.append((name, piece, at, size, zlib.crc32(part),
                                     *([np.frombuffer(part, "<i4")] if keep_ids else [])))
                        at, size = at + size, capacity
                found = pd.DataFrame(rows, columns=[f.name for f in fields])
                yield numbering.added(found) if numbering else found

    return df.select(id_column, text).mapInPandas(pieces, _numbered(schema) if numbered else schema)


@dataclass
class Runs:
    """Of one length: which run of equal fillings takes the pieces from which number on."""
    first: list[int] = field(default_factory=list)  # the first number
    each: list[int] = field(default_factory=list)  # pieces of this length in a bin
    bin: list[int] = field(default_factory=list)  # the run's first bin
    offset: list[int] = field(default_factory=list)  # of the first such piece in its bin
    used: int = 0


def filling(counts: np.ndarray, capacity: int) -> Counter:
    """The lengths of the next bin; ``counts[n]`` pieces of length n are unpacked."""
    left = counts.copy()
    chosen: Counter = Counter()
    gap = capacity
    while gap and len(fits := np.flatnonzero(left[:gap + 1])):
        size = int(fits[-1])
        many = min(int(left[size]), gap // size)
        chosen[size] += many
        left[size] -= many
        gap -= many * size
    while gap and chosen:
        smallest = min(chosen)
        room = gap + smallest
        there = np.arange(room + 1)
        largest = np.maximum.accumulate(np.where(left[:room + 1] > 0, there, 0))  # that is at most this long
        larger = there[(left[:room + 1] > 0)]
        partner = largest[room - larger]
        alone = (partner == larger) & (left[larger] < 2)
        partner = np.where(alone, largest[np.maximum(larger - 1, 0)], partner)
        both = np.where(partner > 0, larger + partner, 0)
        if not len(both) or both.max() <= smallest:
            break
        best = int(both.argmax())
        chosen[smallest] -= 1
        chosen += Counter()  # drops zero counts
        left[smallest] += 1
        for size in (int(larger[best]), int(partner[best])):
            chosen[size] += 1
            left[size] -= 1
        gap = room - int(both[best])
    return chosen


def plan(lengths: dict[int, int], capacity: int) -> dict[int, Runs]:
    """Places for ``lengths[n]`` pieces of each length n. Every filling uses up a length, so there are few."""
    counts = np.zeros(capacity + 1, np.int64)
    for size, many in lengths.items():
        counts[size] = many
    runs: dict[int, Runs] = {size: Runs() for size in lengths}
    bins = 0
    while counts.any():
        chosen = filling(counts, capacity)
        times = min(int(counts[size]) // many for size, many in chosen.items())
        offset = 0
        for size, many in sorted(chosen.items(), reverse=True):
            run = runs[size]
            run.first.append(run.used)
            run.each.append(many)
            run.bin.append(bins)
            run.offset.append(offset)
            run.used += times * many
            offset += many * size
            counts[size] -= times * many
        bins += times
    return runs


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: as few sequences of ``capacity`` as best-two-fit finds.

    ``pieces.length`` is 1 to ``capacity`` in every row. Sequences have no gaps
    before their end. Equal lengths are interchangeable, so equal and repeated
    rows are no special case; an empty table gives an empty one. Pieces that
    ``cut_documents`` has numbered are not numbered again.
    """
    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbering = Numbering(capacity)
        for batch in batches:
            yield numbering.added(batch)

    names = [c for c in pieces.columns if c not in NUMBERS]
    if len(names) == len(pieces.columns):
        pieces = pieces.mapInPandas(number, _numbered(pieces.schema))
    # both the counts and the places refer to this numbering, so it is stored
    rows = stored(pieces, "pieces")
    per_slab = rows.groupBy("length", "_slab").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("length").orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_slab.select("length", "_slab", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    # at most one row per length up to the capacity
    lengths = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = {size: [np.array(x, np.int64) for x in (r.first, r.each, r.bin, r.offset)] for size, r in plan(lengths, capacity).items()}
    out = T.StructType([*(pieces.schema[n] for n in names), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            number = batch["_nth"].to_numpy(np.int64) + batch["_shift"].to_numpy(np.int64)
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for size, at in batch.groupby("length").indices.items():
                first, each, bin_, start = runs[int(size)]
                run = np.searchsorted(first, number[at], "right") - 1
                inside = number[at] - first[run]
                sequence[at] = bin_[run] + inside // each[run]
                offset[at] = start[run] + inside % each[run] * int(size)
            yield batch[names].assign(sequence_id=sequence, offset=offset)

    return rows.join(shifts, ["length", "_slab"]).select(*names, "_nth", "_shift").mapInPandas(placed, out)


def pack_documents(df: DataFrame, path: str, capacity: int, end_id: int = 0) -> DataFrame:
    """Documents cut and packed; ``df`` needs ``doc_id`` and ``text``."""
    return pack(cut_documents(df, path, capacity, end_id, numbered=True), capacity)
