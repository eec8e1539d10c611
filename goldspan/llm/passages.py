"""Removal of repeated word passages, by windows that double in length.

A window can only repeat if the shorter windows in it do. So windows of half
the length are tested first, and only where one repeats is a window of twice
that length formed. At the first length one window in four is enough: each full
window is tested by the one of its halves' places with the smallest hash, which
equal windows choose alike. Texts are dealt to *slabs* by their ids; what a slab
must know from others comes back to it as a few hash lists, never as rows per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldspan.llm.vocabulary import strides
from goldspan.llm.words import (SENT, _ranges, _runs, codes_of, is_told, mix, repeated, send, slabs_for, windows,
                                word_hashes, words_of)
from goldspan.session import stored

SLAB_BYTES = 6 << 20


class Windows:
    """The windows of several documents, one after the other."""

    def __init__(self, words: list[list[bytes]], length: int):
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.doc = np.repeat(np.arange(len(words)), self.sizes)
        hashes = word_hashes([w for doc in words for w in doc])
        self.length, self.half = length, (length + 1) // 2
        self.halves = windows(hashes, self.half)
        n = max(0, len(hashes) - length + 1)
        # windows that do not run into the next document
        self.places = np.flatnonzero(self.doc[:n] == self.doc[length - 1:]) if n else np.zeros(0, np.int64)
        # of each: the place of its half-length window with the smallest hash
        self.pick = self.places.copy()
        least = self.halves[self.places]
        for i in range(1, length - self.half + 1):
            value = self.halves[self.places + i]
            better = value < least
            least = np.where(better, value, least)
            self.pick = np.where(better, self.places + i, self.pick)

    def picked(self) -> np.ndarray:
        """The places of half-length windows that are tested."""
        return np.unique(self.pick)

    def grown(self, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The full windows whose half repeats: their places and hashes, made of their two halves."""
        at = self.places[repeats[np.searchsorted(self.picked(), self.pick)]] if len(self.places) else self.places
        first, second = self.halves[at], self.halves[at + self.length - self.half]
        return at, mix(first * np.uint64(0xD6E8FEB86659FD93) + second)


def mark_repeats(df: DataFrame, length: int, ident: str, text: str, carried: list[str], out, schema) -> DataFrame:
    """``out(rows, words, covered)`` for the documents of each slab; ``covered``: the word is in a window that a
    document with a smaller id has too. Rows have ``_id``, ``_text`` and the ``carried`` columns as ``_more``."""
    _, slabs = slabs_for(df, text, SLAB_BYTES)
    slab = F.pmod(F.xxhash64(F.col(ident)), F.lit(slabs)).cast("int").alias("slab")
    texts = df.select(slab, F.col(ident).cast("long").alias("_id"), F.col(text).alias("_text"))

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slab_, all_texts = batch.column(0).to_numpy(), batch.column(2).to_pylist()
            for start, end in strides(all_texts):
                w = Windows([words_of(t) for t in all_texts[start:end]], length)
                at = w.picked()
                rows = list(send(w.halves[at], w.doc[at], slab_[start:end][w.doc[at]], slabs))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema(
                        [("bucket", pa.int32()), ("slab", pa.int32()), ("keys", pa.binary()), ("slabs", pa.binary()), ("known", pa.binary())]))

    told = repeated(texts.mapInArrow(halves, SENT), slabs, "halves")

    def work(texts_: pd.DataFrame, codes: np.ndarray):
        """The slab's documents by id, their windows, and the full windows that are candidates."""
        texts_ = texts_.sort_values("_id", ignore_index=True, kind="stable")
        words = [words_of(t) for t in texts_["_text"]]
        w = Windows(words, length)
        at, hashes = w.grown(is_told(w.halves[w.picked()], codes, slabs))
        ids = texts_["_id"].to_numpy(np.int64) if len(texts_) else np.zeros(0, np.int64)
        # equal windows side by side, smallest document first; buckets by bits that the comparison does not need
        bucket = (mix(hashes ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(slabs)).astype(np.int64)
        order = np.lexsort((w.doc[at], hashes, bucket))
        at, hashes, bucket = at[order], hashes[order], bucket[order]
        new = _runs(bucket, hashes) if len(at) else np.zeros(0, bool)
        return words, ids, w, at, hashes, bucket, new

    def full(key, texts_: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        _, ids, w, at, hashes, bucket, new = work(texts_, codes_of(answers["codes"]))
        first, hashes, bucket = at[new], hashes[new], bucket[new]
        docs = w.doc[first].astype(np.uint32)
        rows = []
        for a, b in _ranges(bucket):
            names, place = np.unique(docs[a:b], return_inverse=True)
            rows.append((int(bucket[a]), int(key[0]), hashes[a:b].tobytes(), place.astype(np.uint32).tobytes(), ids[names].tobytes()))
        return pd.DataFrame(rows, columns=["bucket", "slab", "hashes", "docs", "ids"])

    def smaller(rows: pd.DataFrame) -> pd.DataFrame:
        """For each slab's windows in this bucket: is there a smaller document with the same one?"""
        sizes = [len(h) // 8 for h in rows["hashes"]]
        hashes = np.frombuffer(b"".join(rows["hashes"]), np.uint64)
        ids = np.concatenate([np.frombuffer(i, np.int64)[np.frombuffer(d, np.uint32)] for i, d in zip(rows["ids"], rows["docs"])])
        order = np.lexsort((ids, hashes))
        run = np.cumsum(_runs(hashes[order])) - 1
        least = ids[order][np.flatnonzero(_runs(hashes[order]))][run]
        answer = np.empty(len(ids), bool)
        answer[order] = least < ids[order]
        ends = np.cumsum(sizes)
        return pd.DataFrame({"slab": rows["slab"], "bucket": rows["bucket"],
                             "bits": [np.packbits(answer[e - n:e]).tobytes() for e, n in zip(ends, sizes)]})

    by_slab = texts.groupBy("slab")
    sent = by_slab.cogroup(told.groupBy("slab")).applyInPandas(full, "bucket int, slab int, hashes binary, docs binary, ids binary")
    answers = stored(sent.groupBy("bucket").applyInPandas(smaller, "slab int, bucket int, bits binary"), "passages")
    both = told.select("slab", "codes", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("bits")).unionByName(
        answers.withColumn("codes", F.lit(None).cast("binary")))

    def finish(texts_: pd.DataFrame, said: pd.DataFrame) -> pd.DataFrame:
        words, ids, w, at, hashes, bucket, new = work(texts_, codes_of(said["codes"][said["codes"].notna()]))
        elsewhere = np.zeros(int(new.sum()), bool)
        bits = dict(zip(said["bucket"][said["bits"].notna()], said["bits"][said["bits"].notna()]))
        for a, b in _ranges(bucket[new]):
            packed = np.frombuffer(bits[int(bucket[new][a])], np.uint8)
            elsewhere[a:b] = np.unpackbits(packed, count=b - a).astype(bool)
        if len(at):
            run = np.cumsum(new) - 1
            repeat = elsewhere[run] | (ids[w.doc[at]] > ids[w.doc[at[new]]][run])
            at = at[repeat]
        many = int(w.sizes.sum()) + 1
        opened, closed = np.bincount(at, minlength=many), np.bincount(at + length, minlength=many)
        covered = np.cumsum(opened - closed)[:-1] > 0
        return out(texts_.sort_values("_id", ignore_index=True, kind="stable"), words,
                   [covered[s:s + n] for s, n in zip(w.starts, w.sizes)])

    whole = df.select(slab, F.col(ident).cast("long").alias("_id"), F.col(text).alias("_text"),
                      F.struct(F.lit(0).alias("_"), *carried).alias("_more"))
    return whole.groupBy("slab").cogroup(both.groupBy("slab")).applyInPandas(finish, schema)


def _kept(words: list[bytes], gone: np.ndarray) -> str:
    return b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words).decode()


def _of_all(df: DataFrame, length: int, ident: str, text: str, carried: list[str], out, schema: str) -> DataFrame:
    """``out(rows, words, covered)`` for all rows of ``df``; those without id keep all words."""
    found = mark_repeats(df.where(F.col(ident).isNotNull()), length, ident, text, carried, out, schema)

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [words_of(t) for t in batch["_text"]]
            yield out(batch, words, [np.zeros(len(w), bool) for w in words])

    nameless = df.where(F.col(ident).isNull()).select(
        F.col(ident).cast("long").alias("_id"), F.col(text).alias("_text"), F.struct(F.lit(0).alias("_"), *carried).alias("_more")) \
        .mapInPandas(whole, schema)
    return found.unionByName(nameless)


def remove_passages(df: DataFrame, length: int = 13, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (its other words, joined by one space).

    A word goes if it is in a window of ``length`` consecutive words that also
    starts in a document with a smaller id; windows are judged on the input. A
    null text has no words. Rows with the same id do not take words from each
    other. Rows without id keep all words. An empty table gives an empty result;
    other columns are not used. Windows are compared by 64-bit hashes within
    buckets chosen by other bits.
    """
    def rows(found: pd.DataFrame, words, covered) -> pd.DataFrame:
        return pd.DataFrame({
            "doc_id": found["_id"].to_numpy(), "n_words": [len(w) for w in words], "n_removed": [int(c.sum()) for c in covered],
            "kept": [_kept(w, c) for w, c in zip(words, covered)]})

    return _of_all(df, length, ident, text, [], rows, "doc_id long, n_words long, n_removed long, kept string") \
        .withColumnRenamed("doc_id", ident)


def rewrite(df: DataFrame, carried: list[str], length: int = 13, ident: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The rows of ``df`` with shortened texts: ``carried`` columns, ``text``, ``n_chars``.

    As ``remove_passages``, but a text that loses no word is left as it is, with
    its ``n_chars``, and one that loses all its words becomes empty.
    """
    schema = T.StructType([T.StructField("_text", T.StringType()), T.StructField("_changed", T.BooleanType()),
                           T.StructField("_more", T.StructType([T.StructField("_", T.IntegerType(), False),
                                                                *(df.schema[c] for c in [*carried, n_chars])]))])

    def rows(found: pd.DataFrame, words, covered) -> pd.DataFrame:
        texts = [_kept(w, c) if c.any() else t for w, c, t in zip(words, covered, found["_text"])]
        return pd.DataFrame({"_text": pd.Series(texts, dtype=object), "_changed": pd.Series([bool(c.any()) for c in covered], dtype=bool),
                             "_more": found["_more"].to_numpy()}, columns=["_text", "_changed", "_more"])

    found = _of_all(df, length, ident, text, [*carried, n_chars], rows, schema)
    size = F.when(F.col("_changed"), F.length("_text")).otherwise(F.col(f"_more.{n_chars}")).cast(df.schema[n_chars].dataType)
    return found.select(*[F.col("_more")[c].alias(c) for c in carried], F.col("_text").alias(text), size.alias(n_chars))


def digests(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM d, unnest(range(1, len(w) - 11)) AS u(i)),
f AS (SELECT g, min(doc_id) AS least FROM g GROUP BY g),
c AS (SELECT DISTINCT g.doc_id, g.i + k AS i FROM g JOIN f USING (g), unnest(range(0, 13)) AS u(k) WHERE f.least < g.doc_id),
r AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w
    ELSE [w[i] for i in range(1, len(w) + 1) if NOT list_contains(gone, i)] END, ' ')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""
