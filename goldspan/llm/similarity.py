"""Documents whose word shingles have a Jaccard similarity of at least a threshold, and their components.

Equal shingle sets are one class. Of every class the shingles are put in one
order, rare ones first (frequencies from a table of hashed counters over all
documents), and two classes can only be similar if they share a shingle in their
prefixes. Candidates that share one pass a length and a positional filter, and
each remaining pair is verified once, after a suffix filter, on the whole sets.

A shingle that thousands of classes share must not make all their pairs. So
each shared shingle first offers the pairs with its least class only; classes
found similar are joined. What a second round then offers are the pairs of
classes that share a shingle but are not joined yet. Pairs never offered are
joined already, so the components are those of all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldspan.llm.graph import components
from goldspan.llm.vocabulary import strides
from goldspan.llm.words import (ODD, SENT, codes_of, is_told, mix, repeated, send, slabs_for, windows, word_hashes,
                                words_of)
from goldspan.session import stored

SLAB_BYTES = 6 << 20
COUNTERS = 1 << 18  # of the frequency table: 2 MB, whatever the corpus
SLICE = 1 << 14
PARTS = 512  # of a set, for the suffix filter: one byte each
BITS = 1 << 26  # of the table of documents in candidate pairs: 8 MB


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct hashes of a text's word shingles, A-Z in lower case."""
    hashes = word_hashes(words_of(text, lower=True))
    if not len(hashes):
        return hashes
    if len(hashes) < size:
        whole = np.zeros(1, np.uint64)
        for h in hashes:
            whole = whole * ODD + h
        return mix(whole ^ np.uint64(len(hashes)))  # no shingle of full size has this form
    return np.unique(windows(hashes, size))


def least_overlap(a: Column, b: Column, num: int, den: int) -> Column:
    """The overlap that sets of these sizes need: Jaccard num/den means overlap / (a + b - overlap)."""
    return F.ceil((a + b) * num / (num + den))


def _shingles(df: DataFrame, size: int, tell, schema: str) -> DataFrame:
    """``tell(id, set)`` for every text of ``df`` (``_id``, ``_text``); one row each."""
    names = [f.split()[0] for f in schema.split(",")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, texts = batch["_id"].tolist(), batch["_text"].tolist()
            for start, end in strides(texts):
                found = [tell(i, shingle_set(t, size)) for i, t in zip(ids[start:end], texts[start:end])]
                yield pd.DataFrame([f for f in found if f], columns=names)

    return df.mapInPandas(rows, schema)


def _fingerprints(df: DataFrame, size: int) -> DataFrame:
    """Per document its set's size and 128-bit hash; per task the counters of its shingles, in slices."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            ids, texts = batch["_id"].tolist(), batch["_text"].tolist()
            for start, end in strides(texts):
                out, sets = [], []
                for i, t in zip(ids[start:end], texts[start:end]):
                    s = shingle_set(t, size)
                    one, two = (int(mix(s ^ np.uint64(salt)).sum(dtype=np.uint64)) for salt in (0x51ED270B, 0xB7E15162))
                    out.append((i, len(s), one - (1 << 63), two - (1 << 63)))
                    sets.append(s)
                places = (np.concatenate(sets) & np.uint64(COUNTERS - 1)).astype(np.int64)
                counters += np.bincount(places, minlength=COUNTERS)
                yield pd.DataFrame(out, columns=["_id", "n", "one", "two"]).assign(slice=-1, task=0, counters=None)
        task = TaskContext.get().partitionId()
        if counters.any():
            yield pd.DataFrame([(None, 0, 0, 0, at // SLICE, task, counters[at:at + SLICE].tobytes()) for at in range(0, COUNTERS, SLICE)],
                               columns=["_id", "n", "one", "two", "slice", "task", "counters"])

    return df.mapInPandas(rows, "_id long, n long, one long, two long, slice int, task int, counters binary")


def _frequencies(prints: DataFrame) -> np.ndarray:
    """The counters of all tasks, added up in two steps so that no group grows with the number of tasks alone."""
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SLICE, np.int64)
        for c in rows["counters"]:
            total += np.frombuffer(c, np.int64)
        return pd.DataFrame({"slice": [rows["slice"].iloc[0]], "counters": [total.tobytes()]})

    parts = prints.where("slice >= 0").withColumn("part", F.col("task") % 256)
    some = parts.groupBy("slice", "part").applyInPandas(add, "slice int, counters binary")
    whole = some.groupBy("slice").applyInPandas(add, "slice int, counters binary").collect()  # COUNTERS numbers
    total = np.zeros(COUNTERS, np.int64)
    for row in whole:
        total[row["slice"] * SLICE:(row["slice"] + 1) * SLICE] = np.frombuffer(row["counters"], np.int64)
    return total


def _tokens(shingles: np.ndarray, frequencies: np.ndarray) -> np.ndarray:
    """The shingles in the common order: by counter, then hash. Both are kept in one number."""
    often = np.minimum(frequencies[(shingles & np.uint64(COUNTERS - 1)).astype(np.int64)], (1 << 23) - 1).astype(np.int64)
    return np.sort(often << 40 | (shingles >> np.uint64(24)).astype(np.int64))


def parts_of(shingles: np.ndarray) -> bytes:
    """How many members fall into each of PARTS fixed ranges of the hashes; 255 stands for any larger number too."""
    return np.minimum(np.bincount((shingles >> np.uint64(64 - PARTS.bit_length() + 1)).astype(np.int64), minlength=PARTS), 255) \
        .astype(np.uint8).tobytes()


def most_overlap(a: bytes, b: bytes, size_a: int, size_b: int) -> int:
    """The suffix filter: split at fixed pivots, two sets have no more in common than the smaller side of each part."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    smaller = np.minimum(x, y)
    return min(size_a, size_b) if (smaller == 255).any() else int(smaller.sum(dtype=np.int64))


def _members(ids: DataFrame) -> np.ndarray:
    """A table of BITS bits with those of the hashed ids (``_id``) set. An id that is in is always told so; with very
    many ids others are as well, which costs work but changes nothing."""
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << 16, bool)
        bits[rows["at"].to_numpy() & 0xFFFF] = True
        return pd.DataFrame({"part": [int(rows["at"].iloc[0]) >> 16], "bits": [np.packbits(bits).tobytes()]})

    places = ids.select(_bit("_id").alias("at")).distinct().withColumn("part", F.shiftright("at", 16))
    bits = np.zeros(BITS >> 3, np.uint8)
    for row in places.groupBy("part").applyInPandas(pack, "part int, bits binary").collect():  # BITS bits at most
        bits[row["part"] << 13:(row["part"] + 1) << 13] = np.frombuffer(row["bits"], np.uint8)
    return bits


def _bit(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BITS)).cast("int")


def _is_member(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def verify(pairs: DataFrame, texts: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Of the pairs (``a``, ``b``), those whose sets are similar enough; each is compared once.

    Texts stay where they are: only the sets of documents in a pair move.
    """
    in_a, in_b = _members(pairs.select(F.col("a").alias("_id"))), _members(pairs.select(F.col("b").alias("_id")))

    def wanted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = batch["_at"].to_numpy()
            as_a, as_b = _is_member(in_a, at), _is_member(in_b, at)
            batch = batch.assign(as_a=as_a, as_b=as_b)[as_a | as_b]
            texts_ = batch["_text"].tolist()
            for start, end in strides(texts_):
                part = batch.iloc[start:end]
                sets_ = [shingle_set(t, size) for t in texts_[start:end]]
                yield pd.DataFrame({"_id": part["_id"], "as_a": part["as_a"], "as_b": part["as_b"], "n": [len(x) for x in sets_],
                                    "parts": [parts_of(x) for x in sets_], "members": [x.tobytes() for x in sets_]})

    known = texts.where(F.col("_id").isNotNull()).withColumn("_at", _bit("_id"))
    sets = stored(known.mapInPandas(wanted, "_id long, as_a boolean, as_b boolean, n long, parts binary, members binary"), "sets")

    def beside(pairs_: DataFrame, sets_: DataFrame, *columns: str) -> DataFrame:
        # neither pairs nor sets have a bound, so they are merged at every size; a crowded document's part is split
        of = lambda side: sets_.where(f"as_{side}").select(
            F.col("_id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]).hint("merge")
        return pairs_.join(of("b"), "b").join(of("a"), "a")

    def possible(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [most_overlap(x, y, m, n) >= -(-(m + n) * num // (num + den)) for x, y, m, n in zip(
                batch["parts_a"], batch["parts_b"], batch["n_a"], batch["n_b"])]
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    left = stored(beside(pairs, sets.drop("members"), "n", "parts").mapInPandas(possible, "a long, b long"), "possible")
    by_a, by_b = _members(left.select(F.col("a").alias("_id"))), _members(left.select(F.col("b").alias("_id")))

    def still(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = batch["_at"].to_numpy()
            as_a, as_b = batch["as_a"] & _is_member(by_a, at), batch["as_b"] & _is_member(by_b, at)
            yield batch.assign(as_a=as_a, as_b=as_b)[as_a | as_b].drop(columns="_at")

    moving = sets.drop("n", "parts").withColumn("_at", _bit("_id")).mapInPandas(still, "_id long, as_a boolean, as_b boolean, members binary")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["members_a"], batch["members_b"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * common >= num * (len(x) + len(y) - common))
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    return stored(beside(left, moving, "members").mapInPandas(check, "a long, b long"), "links")


def similar_documents(df: DataFrame, size: int = 5, num: int = 3, den: int = 4, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``: one row per document.

    A document's set holds the distinct shingles of ``size`` consecutive words
    of its whole text, A-Z in lower case; with fewer words, the whole sequence
    as one. Documents link when den * intersection >= num * union. A text that is
    null or has no words has an empty set and links with nothing.
    ``component_id`` is the least id reachable by links, itself included. Rows
    that share an id but not the text are separate documents, and the id gets
    the least component of them; a row without id links with nothing and has
    a null component. An empty table gives an empty result; other columns are
    not used. Shingles are compared by 64-bit hashes.
    """
    texts = df.select(F.col(ident).cast("long").alias("_id"), F.col(text).alias("_text"))
    _, slabs = slabs_for(df, text, SLAB_BYTES)
    prints = stored(_fingerprints(texts, size), "fingerprints")
    frequencies = _frequencies(prints)
    documents = prints.where("slice < 0").select("_id", "n", "one", "two")
    usable = documents.where("n > 0 AND _id IS NOT NULL")
    # a crowded class is one row per task before the shuffle
    classes = usable.groupBy("one", "two", "n").agg(F.min("_id").alias("rep"))
    members = stored(usable.join(classes, ["one", "two", "n"]).select("_id", "rep"), "members")
    reps = members.select(F.col("rep").alias("_id")).distinct()

    def prefix(ident_, shingles):
        n = len(shingles)
        if n and ident_ is not None:
            return ident_, n, _tokens(shingles, frequencies)[:n - -(-num * n // den) + 1].tobytes()

    prefixes = stored(_shingles(texts, size, prefix, "_id long, n long, tokens binary").join(reps, "_id", "left_semi")
                      .withColumn("slab", F.pmod(F.xxhash64("_id"), F.lit(slabs)).cast("int")), "prefixes")

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = [np.frombuffer(t, np.int64) for t in batch.column(0).to_pylist()]
            doc = np.repeat(np.arange(len(flat)), [len(f) for f in flat])
            hashes = mix(np.concatenate(flat).astype(np.uint64)) if flat else np.zeros(0, np.uint64)
            rows = list(send(hashes, doc, batch.column(1).to_numpy()[doc], slabs))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema(
                    [("bucket", pa.int32()), ("slab", pa.int32()), ("keys", pa.binary()), ("slabs", pa.binary()), ("known", pa.binary())]))

    told = repeated(prefixes.select("tokens", "slab").mapInArrow(tell, SENT), slabs, "shared")

    def shared(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        """The prefix tokens that other documents' prefixes have too."""
        codes = codes_of(answers["codes"])
        out = []
        for ident_, n, tokens in zip(rows["_id"], rows["n"], rows["tokens"]):
            tokens = np.frombuffer(tokens, np.int64)
            at = np.flatnonzero(is_told(mix(tokens.astype(np.uint64)), codes, slabs))
            if len(at):
                out.append((ident_, n, at.astype(np.int32), tokens[at]))
        return pd.DataFrame(out, columns=["id", "n", "places", "tokens"])

    holders = stored(prefixes.groupBy("slab").cogroup(told.groupBy("slab")).applyInPandas(
        shared, "id long, n long, places array<int>, tokens array<long>"), "entries")

    def each(rows: DataFrame) -> DataFrame:
        found = rows.withColumn("x", F.explode(F.arrays_zip("tokens", "places"))).drop("tokens", "places")
        return found.withColumns({"token": F.col("x.tokens"), "place": F.col("x.places")}).drop("x")

    entries = each(holders)

    def fits(x: str, y: str) -> Column:
        nx, ny, px, py = F.col(f"{x}.n"), F.col(f"{y}.n"), F.col(f"{x}.place"), F.col(f"{y}.place")
        # of sets whose first common token stands at these places, no more than what follows can be common
        return (F.least(nx, ny) * den >= F.greatest(nx, ny) * num) \
            & (F.least(nx - px, ny - py) >= least_overlap(nx, ny, num, den))

    hubs = entries.groupBy("token").agg(F.min(F.struct("id", "n", "place")).alias("x")).select("token", "x.*")
    pairs = entries.alias("y").join(hubs.alias("x"), "token").where(F.col("x.id") != F.col("y.id")).where(fits("x", "y")) \
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    pairs = stored(pairs, "pairs")
    links = verify(pairs, texts, size, num, den)
    joined = components(links, "a", "b")

    placed = each(holders.join(joined, holders["id"] == joined["node"], "left").select(
        "id", "n", "tokens", "places", F.coalesce("component", "id").alias("part")))
    per_part = placed.groupBy("token", "part").agg(F.count(F.lit(1)).alias("many"))
    split = per_part.groupBy("token").agg(F.max_by("part", F.struct("many", "part")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    open_ = stored(placed.join(split.select("token", "main"), "token"), "open")
    few = open_.where("part <> main")
    apart = (F.col("x.part") != F.col("y.part")) & ((F.col("y.part") == F.col("y.main")) | (F.col("x.id") < F.col("y.id")))
    more = few.alias("x").join(open_.alias("y"), "token").where(apart).where(fits("x", "y")) \
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti")
    more = stored(more, "pairs")
    if not more.isEmpty():
        joined = components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(
            verify(more, texts, size, num, den)), "a", "b")

    place = members.join(joined, members["rep"] == joined["node"], "left").select(
        "_id", F.coalesce("component", "rep").alias("component")).distinct()
    place = place.groupBy("_id").agg(F.min("component").alias("component"))
    return documents.join(place, "_id", "left").select(
        F.col("_id").alias(ident), F.col("n").alias("n_shingles"), F.coalesce("component", "_id").alias("component_id"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM d, unnest(range(1, len(w) - 3)) AS u(i) WHERE len(w) >= 5
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) m USING (doc_id)
"""
