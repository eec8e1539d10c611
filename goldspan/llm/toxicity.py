"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts (P) are learned against unlabelled ones (U), which hold
toxic texts too. With the class prior p, the risk of a scorer g with logistic
loss l is  p E_P[l(g, +)] + max(0, E_U[l(g, -)] - p E_P[l(g, -)]):  the toxic
part of U is taken off the negative risk, which may not fall below zero; where
it does, the step goes the other way.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldspan.llm.kept import kept
from goldspan.llm.vocabulary import strides
from goldspan.llm.words import words_of
from goldspan.session import stored

FEATURES = 1 << 20
TOXIC_SAMPLE = 4_000  # confirmed toxic texts learned from, at most
OTHER_SAMPLE = 16_000  # unlabelled texts learned from, at most
LEAST_TEXTS = 5  # sample texts a feature is in
LEAST_SIGN = 5.5  # standard deviations by which it is commoner or rarer in toxic texts
EPOCHS = 20
PART = 256  # texts scored at a time
EDGE = re.compile(rb"^[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+$")


class FeaturesOfWord(dict):
    """Hashes of a word's lower-case form without marks at its ends, and of its first four, five and six characters
    (other endings of the same stem), as 32-bit numbers. Kept between tasks; bounded."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= 400_000:
            self.clear()
        plain = EDGE.sub(b"", word)
        stem = plain.decode("utf-8", "replace")
        found = self[word] = struct.pack("<4i", *(zlib.crc32(x) % FEATURES for x in (
            plain, *(b"%d " % n + stem[:n].encode() for n in (4, 5, 6)))))
        return found


def features(text: str | None) -> np.ndarray:
    """The distinct features of a whole text, sorted."""
    of_word = kept("features", FeaturesOfWord)
    return np.unique(np.frombuffer(b"".join(map(of_word.__getitem__, set(words_of(text, lower=True)))), "<i4"))


@dataclass
class Model:
    weights: np.ndarray  # by feature; 0 where nothing was learned
    bias: float

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        sums = np.array([self.weights[r].sum() for r in rows]) if rows else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(sums + self.bias, -40, 40)))


def _sums(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[starts + sizes] - total[starts]


def fit(toxic: list[np.ndarray], other: list[np.ndarray], prior: float, epochs: int = EPOCHS, batch: int = 512,
        rate: float = 0.02, decay: float = 2e-4, seed: int = 7) -> Model:
    """The scorer of least non-negative risk, by Adam over mini-batches of both kinds. Without texts: the prior."""
    start = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    if not toxic or not other:
        return Model(np.zeros(FEATURES), start)
    of_toxic, of_other = (np.bincount(np.concatenate(x), minlength=FEATURES) for x in (toxic, other))
    # features whose share among the toxic differs from that among all by more than chance
    share = len(toxic) / (len(toxic) + len(other))
    expected = (of_toxic + of_other) * share
    sign = np.abs(of_toxic - expected) / np.sqrt(np.maximum(expected * (1 - share), 1e-9))
    used = np.flatnonzero((of_toxic + of_other >= LEAST_TEXTS) & (sign >= LEAST_SIGN))
    place = np.full(FEATURES, -1)
    place[used] = np.arange(len(used))
    rows = [place[r][place[r] >= 0] for r in toxic + other]
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate(rows) if len(rows) else np.zeros(0, int)
    starts = np.cumsum(sizes) - sizes
    rng = np.random.default_rng(seed)
    weights, bias = np.zeros(len(used)), start
    first, second = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    step = 0
    for _ in range(epochs):
        others = rng.permutation(len(other)) + len(toxic)
        rounds = max(1, -(-len(others) // batch))
        mine = np.resize(rng.permutation(len(toxic)), max(len(toxic), rounds * min(len(toxic), batch // 4)))
        for u, p in zip(np.array_split(others, rounds), np.array_split(mine, rounds)):
            picked = np.concatenate([p, u])
            n = sizes[picked]
            at = np.cumsum(n) - n
            inside = flat[np.repeat(starts[picked] - at, n) + np.arange(n.sum())]
            g = _sums(weights[inside], at, n) + bias
            s = 1 / (1 + np.exp(-np.clip(g, -40, 40)))
            of_p, of_u = s[:len(p)], s[len(p):]
            loss = np.logaddexp(0, g)  # l(g, -)
            negative = loss[len(p):].mean() - prior * loss[:len(p)].mean()
            slope = np.empty(len(picked))
            if negative >= 0:  # l'(g, +) = s - 1, l'(g, -) = s
                slope[:len(p)] = prior * ((of_p - 1) - of_p) / len(p)
                slope[len(p):] = of_u / len(u)
            else:
                slope[:len(p)] = prior * of_p / len(p)
                slope[len(p):] = -of_u / len(u)
            gradient = np.append(np.bincount(inside, np.repeat(slope, n), minlength=len(used)), slope.sum())
            step += 1
            first += 0.1 * (gradient - first)
            second += 0.001 * (gradient ** 2 - second)
            move = rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
            weights -= move[:-1] + rate * decay * np.sign(weights) + rate * decay * weights
            weights[np.abs(weights) < rate * decay] = 0
            bias -= move[-1]
    whole = np.zeros(FEATURES)
    whole[used] = weights
    return Model(whole, float(bias))


def _with_features(df: DataFrame, ident: str, text: str) -> DataFrame:
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, texts = batch["_id"], batch["_text"].tolist()
            for start, end in strides(texts):
                yield pd.DataFrame({"_id": ids[start:end], "features": [features(t).tobytes() for t in texts[start:end]]})
    return df.select(F.col(ident).alias("_id"), F.col(text).alias("_text")).mapInPandas(
        found, T.StructType([T.StructField("_id", df.schema[ident].dataType), T.StructField("features", T.BinaryType())]))


def train(df: DataFrame, labels: DataFrame, learns: Column, ident: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model:
    """A model of ``labels`` for the rows where ``learns`` (over ``ident``) holds.

    P: at most TOXIC_SAMPLE texts labelled toxic, U: at most OTHER_SAMPLE of the
    texts that have no label, or any label if all have one; both those whose
    ids have the least hashes. The class prior is the toxic share of all labels
    to learn from. Null ids and labels teach nothing; an id counts as toxic if
    one of its labels says so.
    """
    known = labels.where(F.col(ident).isNotNull() & F.col(toxic).isNotNull() & learns).groupBy(ident).agg(F.max(toxic).alias("_toxic"))
    counts = known.agg(F.count(F.lit(1)), F.sum((F.col("_toxic") == 1).cast("long"))).first()
    prior = (counts[1] or 0) / counts[0] if counts[0] else 0.0
    hashed = F.xxhash64(F.col(ident).cast("string"))
    positive = known.where("_toxic = 1").select(ident).orderBy(hashed, ident).limit(TOXIC_SAMPLE)
    # texts without a label; their number is fixed, so their ids may go to every task
    free = df.where(F.col(ident).isNotNull() & learns).select(ident)
    unlabelled = free.join(known.select(ident), ident, "left_anti").orderBy(hashed, ident).limit(OTHER_SAMPLE)
    chosen = {r[0]: 1 for r in positive.collect()}
    rest = [r[0] for r in unlabelled.collect()] or [r[0] for r in free.orderBy(hashed, ident).limit(OTHER_SAMPLE).collect()]
    chosen = {i: 0 for i in rest} | chosen
    if not chosen:
        return fit([], [], prior)
    spark = df.sparkSession
    picked = spark.createDataFrame([(i, p) for i, p in chosen.items()], T.StructType([
        T.StructField(ident, df.schema[ident].dataType), T.StructField("_is", T.IntegerType())]))
    # at most TOXIC_SAMPLE + OTHER_SAMPLE ids of a few bytes
    texts = df.select(ident, F.col(text).alias("_text")).join(F.broadcast(picked), ident).select(
        F.struct(ident, "_is").alias("_key"), "_text")
    seen = stored(_with_features(texts, "_key", "_text").select(
        F.col("_id._is").alias("_is"), F.col(f"_id.{ident}").alias("_id"), "features"), "features")
    sizes = {r["_is"]: r["n"] for r in seen.groupBy("_is").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = np.zeros((2, FEATURES), np.int64)
        for batch in batches:
            for is_, found in zip(batch["_is"], batch["features"]):
                of[is_, np.frombuffer(found, np.int32)] += 1
        used = np.flatnonzero(of.any(0))
        yield pd.DataFrame({"feature": used, "other": of[0, used], "toxic": of[1, used]})

    # only features that pass the test of ``fit`` come to the driver, and each text's share of them
    every, expected = F.col("toxic") + F.col("other"), (F.col("toxic") + F.col("other")) * share
    told = seen.select("_is", "features").mapInPandas(counted, "feature long, other long, toxic long").groupBy("feature").agg(
        F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).where(every >= LEAST_TEXTS) \
        .where(F.abs(F.col("toxic") - expected) >= (LEAST_SIGN - 1e-6) * F.sqrt(expected * (1 - share))).select("feature")
    useful = np.sort(np.array([r[0] for r in told.collect()], np.int32))

    def useful_only(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(features=[np.intersect1d(np.frombuffer(f, np.int32), useful, assume_unique=True).tobytes()
                                         for f in batch["features"]])

    rows = seen.mapInPandas(useful_only, seen.schema).toPandas().sort_values(["_id", "features"], kind="stable")
    sets = [np.frombuffer(x, np.int32) for x in rows["features"]]
    return fit([s for s, p in zip(sets, rows["_is"]) if p], [s for s, p in zip(sets, rows["_is"]) if not p], prior)


def score_texts(df: DataFrame, model: Model, text: str = "text", score: str = "toxicity") -> DataFrame:
    """``df`` with the probability that the whole ``text`` is toxic; one narrow pass.

    Only the text's words count. A null or empty text has no words and gets the
    score of one. ``score`` must be a new name; an empty table gives an empty one.
    """
    if score.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table has a column {score} already")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            found = [s for at in range(0, len(column), PART)
                     for s in model.score([features(t) for t in column.slice(at, PART).to_pylist()])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, score])

    return df.mapInArrow(scored, T.StructType([*df.schema.fields, T.StructField(score, T.DoubleType())]))


def fold(ident: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(ident).cast("string").cast("binary")) % parts


def scores(df: DataFrame, labels: DataFrame, parts: int = 4, held: int = 2, cut: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row; labels of the held-out part are not looked at.

    A row without id is not held out; it teaches nothing, but is scored.
    """
    model = train(df, labels, F.coalesce(fold("doc_id", parts) != held, F.lit(False)))
    found = score_texts(df.select("doc_id", "text"), model, score="score")
    return found.select("doc_id", F.coalesce(fold("doc_id", parts) == held, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= cut).cast("int").alias("predicted"))
