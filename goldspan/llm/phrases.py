"""Phrases whose words stand together more often than their parts' counts suggest, by counting quotient filters.

Texts become numbers of frequent words. A phrase of n words is counted where both of its (n-1)-word phrases are frequent;
its packed number (that of its first n-1 words and that of its last word) goes into the counting quotient filter of its
shard of texts. Sorted filters are cut into ranges of quotients and merged over the shards, 256 at a time, so a frequent
phrase reaches a merge once per shard. The merge that sees all shards tells them which of their phrases are frequent.
Single words, which have no numbers yet, are merged and told in the same way, in ranges of their hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldspan.llm import quotient
from goldspan.session import stored, workspace

SHARD_CHARS = 8 << 20  # text of a shard, more if its last text is longer
TEXTS = 64  # texts taken from a batch at a time
CHUNK_BYTES = 1 << 20  # text split into words at a time
CUT_BITS = 8  # ranges a filter is cut into, and shards that are merged at a time
SALTS = 64
_ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"." * 10)
_BREAK = 0  # a shard's number for the end of a piece
_CODEC = pa.Codec("zstd", compression_level=1)


def squeezed(numbers: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes as the greatest needs, compressed."""
    size = next(n for n in (1, 2, 4, 8) if int(numbers.max(initial=0)) < 1 << 8 * n)
    return bytes([size]) + len(numbers).to_bytes(8, "little") + _CODEC.compress(numbers.astype(f"<u{size}").tobytes(), asbytes=True)


def unsqueezed(blob: bytes) -> np.ndarray:
    size, many = blob[0], int.from_bytes(blob[1:9], "little")
    return np.frombuffer(_CODEC.decompress(blob[9:], size * many), f"<u{size}")


# --- filters of numbers and of words ------------------------------------------------------

class Numbers(NamedTuple):
    """Counting quotient filters of keys of ``bits`` bits, cut into 2^cut_bits ranges at a time."""

    bits: int
    cut_bits: int

    def unpacked(self, blob: bytes):
        return quotient.unpacked(blob)

    def merged(self, filters: list):
        return quotient.merged(filters)

    def cut(self, keys, counts, depth: int) -> list[tuple[int, bytes]]:
        """The filters of the ranges, of a filter that has been cut ``depth`` times."""
        return quotient.cut(keys, counts, self.bits - self.cut_bits * depth, self.cut_bits)

    def told(self, keys, own, leaf: bool) -> tuple[np.ndarray, bytes]:
        """Which of ``keys`` a node's filter holds, and these as the node is told them."""
        held = np.isin(keys, own, assume_unique=True)
        return held, keys[held].tobytes()

    def answered(self, ranges, blobs, depth: int):
        """What a node was told for the ranges it cut itself into."""
        rest = np.uint64(self.bits - self.cut_bits * (depth + 1))
        return np.concatenate([np.uint64(r & ((1 << self.cut_bits) - 1)) << rest | np.frombuffer(b, np.uint64) for r, b in zip(ranges, blobs)])

    def blob(self, keys) -> bytes:
        return keys.tobytes()


class Words(NamedTuple):
    """Counts of words (each with its language), in ranges of a hash."""

    cut_bits: int

    def packed(self, keys: pa.Array, counts: np.ndarray) -> bytes:
        texts = self.blob(keys)
        return len(texts).to_bytes(8, "little") + texts + squeezed(counts)

    def blob(self, keys: pa.Array) -> bytes:
        lengths = squeezed(pc.binary_length(keys).to_numpy(zero_copy_only=False))
        data = b"".join(keys.to_pylist())
        return len(lengths).to_bytes(8, "little") + len(data).to_bytes(8, "little") + lengths + _CODEC.compress(data, asbytes=True)

    def keys(self, blob: bytes) -> pa.Array:
        at = 16 + int.from_bytes(blob[:8], "little")
        ends = np.concatenate([[0], np.cumsum(unsqueezed(blob[16:at]), dtype=np.int64)]).astype(np.int32)
        data = _CODEC.decompress(blob[at:], int.from_bytes(blob[8:16], "little"))
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])

    def unpacked(self, blob: bytes):
        end = 8 + int.from_bytes(blob[:8], "little")
        return self.keys(blob[8:end]), unsqueezed(blob[end:]).astype(np.int64)

    def merged(self, filters: list):
        both = pa.concat_tables([pa.table({"key": k, "n": pa.array(c)}) for k, c in filters]).group_by("key").aggregate([("n", "sum")])
        return both["key"].combine_chunks(), both["n_sum"].to_numpy()

    def ordered(self, keys, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The order of the ranges, and the range of each word in that order."""
        shift, mask = 32 - self.cut_bits * (depth + 1), (1 << self.cut_bits) - 1
        part = np.fromiter((zlib.crc32(k) >> shift & mask for k in keys.to_pylist()), np.int64, len(keys))
        order = np.argsort(part, kind="stable")
        return order, part[order]

    def cut(self, keys, counts, depth: int) -> list[tuple[int, bytes]]:
        order, part = self.ordered(keys, depth)
        keys, counts = keys.take(pa.array(order)), counts[order]
        edges = np.flatnonzero(np.diff(part, prepend=-1))
        return [(int(part[at]), self.packed(keys.slice(at, end - at), counts[at:end])) for at, end in zip(edges, [*edges[1:], len(part)])]

    def told(self, keys, own, leaf: bool) -> tuple[np.ndarray, bytes]:
        """A shard is told its words by their places in its own list."""
        places = pc.index_in(keys, value_set=own)
        held = pc.is_valid(places).to_numpy(zero_copy_only=False)
        if leaf:
            return held, squeezed(places.drop_null().to_numpy().astype(np.uint32))
        return held, self.blob(keys.filter(pa.array(held)))

    def answered(self, ranges, blobs, depth: int):
        return pa.concat_arrays([self.keys(b) for b in blobs])


FILTERS = "node long, range long, filter binary"
TOLD = "node long, range long, keys binary, ids binary, counts binary"  # counts: of all shards, with node null


def _above(nodes: int) -> F.Column:
    """The node in which a node's filters are merged with those of about 255 others."""
    return F.pmod(F.xxhash64("node"), F.lit(-(-nodes >> CUT_BITS) or 1))


def _merge(filters: DataFrame, nodes: int, kind: Numbers | Words, depth: int) -> DataFrame:
    """Filters merged over groups of nodes and cut further; stored."""
    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        both = kind.merged([kind.unpacked(f) for f in rows["filter"]])
        return pd.DataFrame([(key[0], key[1] << CUT_BITS | p, f) for p, f in kind.cut(*both, depth)], columns=["node", "range", "filter"])

    return stored(filters.groupBy(_above(nodes).alias("_node"), "range").applyInPandas(merge, FILTERS), "phrase-filters")


def _settle(filters: DataFrame, kind: Numbers | Words, least: int, leaf: bool) -> DataFrame:
    """The last merge, of all nodes: each range's frequent keys with their counts (node null), and for each node those
    that it holds. ids: range and rank within it. Stored."""
    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        part, each = int(rows["range"].iloc[0]), [kind.unpacked(f) for f in rows["filter"]]
        keys, counts = kind.merged(each)
        often = counts >= least
        keys, counts = keys.filter(pa.array(often)) if isinstance(keys, pa.Array) else keys[often], counts[often]
        ids = np.uint64(part << 32) | np.arange(len(keys), dtype=np.uint64)
        out = [(None, part, kind.blob(keys), ids.tobytes(), counts.astype(np.int64).tobytes())] if len(keys) else []
        for node, (own, _) in zip(rows["node"], each):
            held, blob = kind.told(keys, own, leaf)
            if held.any():
                out.append((node, part, blob, ids[held].tobytes(), b""))
        return pd.DataFrame(out, columns=["node", "range", "keys", "ids", "counts"]).astype({"node": "Int64"})

    return stored(filters.groupBy("range").applyInPandas(settle, TOLD), "phrase-counts")


def _tell(told: DataFrame, filters: DataFrame, nodes: int, kind: Numbers | Words, depth: int) -> DataFrame:
    """What the nodes merged from ``filters`` (cut ``depth`` + 1 times) were told, handed on to the nodes that held them."""
    def tell(answers: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(answers):
            keys = kind.answered(answers["range"], answers["keys"], depth + 1)
            ids = np.concatenate([np.frombuffer(i, np.uint64) for i in answers["ids"]])
            for node, part, own in zip(rows["node"], rows["range"], rows["filter"]):
                held, blob = kind.told(keys, kind.unpacked(own)[0], depth == 0)
                if held.any():
                    out.append((node, part, blob, ids[held].tobytes(), b""))
        return pd.DataFrame(out, columns=["node", "range", "keys", "ids", "counts"])

    above = told.groupBy("node", F.shiftright("range", CUT_BITS).alias("_range"))
    below = filters.groupBy(_above(nodes).alias("node"), F.col("range").alias("_range"))
    return above.cogroup(below).applyInPandas(tell, TOLD)


class Counted(NamedTuple):
    """``whole``: rows of frequent keys; ``told``: rows for the shards that hold them; ``ids_of``: ids as stored there to
    final ones, of ``bits`` bits; ``depth``: how often ranges were cut."""

    whole: DataFrame
    told: DataFrame
    rank_bits: int
    depth: int

    @property
    def bits(self) -> int:
        return CUT_BITS * self.depth + self.rank_bits

    def ids_of(self):
        rank = self.rank_bits
        return lambda blob: (x := np.frombuffer(blob, np.uint64)) >> np.uint64(32) << np.uint64(rank) | x & np.uint64((1 << 32) - 1)


def rounds(nodes: int) -> list[int]:
    """Number of nodes before each round of merging; the last round leaves one."""
    below = [nodes]
    while below[-1] > 1 << CUT_BITS:
        below.append(-(-below[-1] >> CUT_BITS))
    return below


def count_over_shards(filters: DataFrame, nodes: int, kind: Numbers | Words, least: int) -> Counted:
    """Shards' filters, each cut once, merged round by round; what all of them hold ``least`` times is told to them."""
    below, levels = rounds(nodes), [filters]
    for depth, many in enumerate(below[:-1]):
        levels.append(_merge(levels[-1], many, kind, depth + 1))
    settled = _settle(levels[-1], kind, least, len(below) == 1)
    whole, told = settled.where("node IS NULL"), settled.where("node IS NOT NULL")
    most = whole.agg(F.max(F.octet_length("ids") / 8)).first()[0] or 1
    for depth in range(len(below) - 2, -1, -1):
        told = _tell(told, levels[depth], below[depth], kind, depth)
    return Counted(whole, told, max(1, (int(most) - 1).bit_length()), len(below))


# --- texts ------------------------------------------------------------------------------

class _Numbered(dict):
    """Numbers of words in the order in which they first occur."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def word_numbers(text: str | None, numbers: _Numbered) -> Iterator[np.ndarray]:
    """Numbers of a text's words, a chunk at a time, with ``_BREAK`` between pieces and at the end."""
    data = (text or "").encode().lower().translate(_ENDS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + CHUNK_BYTES)
        part = data[at:] if end < 0 else data[at:end]
        at += len(part)
        # no word holds a full stop any more, and only spaces and tabs are left to split at
        words = part.replace(b".", b" . ").split()
        yield np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words))
    yield np.array([_BREAK], np.uint32)


SHARDS = "kind string, node long, range long, lang string, n long, filter binary, starts binary"


def shards(df: DataFrame, text: str, lang: str) -> DataFrame:
    """Texts cut into shards, stored by kind of row: ``words``, the filters of a shard's words (word, space, language);
    ``text``, its texts as places in the list of these, from 1 (``_BREAK`` ends a piece), and where each range of the list
    starts; ``total``, the word occurrences of a language."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        kept: dict[str, tuple[_Numbered, list[np.ndarray]]] = {}
        held, kind = 0, Words(CUT_BITS)

        def flushed() -> Iterator[pa.RecordBatch]:
            rows, keys, counts, texts = [], [], [], []
            for name, (numbers, found) in kept.items():
                own = np.concatenate(found)
                many = np.bincount(own, minlength=len(numbers))[1:]
                texts.append(np.where(own == _BREAK, 0, own + np.uint32(len(keys))))
                keys += [w + b" " + name.encode() for w in list(numbers)[1:]]
                counts.append(many)
                rows.append(("total", shard, None, name, int(many.sum()), None, None))
                found.clear()
            keys, counts = pa.array(keys, pa.binary()), np.concatenate(counts)
            order, part = kind.ordered(keys, 0)
            place = np.zeros(len(keys) + 1, np.uint32)
            place[order + 1] = np.arange(1, len(keys) + 1)
            starts = np.searchsorted(part, np.arange((1 << CUT_BITS) + 1))
            rows += [("words", shard, p, None, None, f, None) for p, f in kind.cut(keys, counts, 0)]
            rows.append(("text", shard, None, None, None, squeezed(place[np.concatenate(texts)]), squeezed(starts)))
            for row in rows:
                yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, row))], schema=kinds)
            kept.clear()

        for batch in batches:
            for at in range(0, len(batch), TEXTS):
                part = batch.slice(at, TEXTS).to_pydict()
                for one, name in zip(part["_text"], part["_lang"]):
                    numbers, found = kept.setdefault(name, (_Numbered({b".": _BREAK}), []))
                    found += word_numbers(one, numbers)
                    held += len(one or "")
                if held >= SHARD_CHARS:
                    yield from flushed()
                    shard, held = shard + 1, 0
        if kept:
            yield from flushed()

    kinds = pa.schema([("kind", pa.string()), ("node", pa.int64()), ("range", pa.int64()), ("lang", pa.string()), ("n", pa.int64()),
                       ("filter", pa.binary()), ("starts", pa.binary())])
    path = workspace(df.sparkSession, "phrase-shards")
    texts = df.select(F.col(text).alias("_text"), F.coalesce(lang, F.lit("und")).alias("_lang"))
    texts.mapInArrow(split, SHARDS).write.partitionBy("kind").parquet(path)
    return df.sparkSession.read.schema(SHARDS).parquet(path)


STATE = "shard long, starts binary, id binary, last binary"
_NO_STATE = ["shard", "starts", "id", "last"]


def _state(shard: int, place: np.ndarray, ident: np.ndarray, last: np.ndarray | None) -> pd.DataFrame:
    """The frequent phrases of one length in a shard: a bit for each place (does one start there?), their ids, and the
    ids of their last words (empty for single words, which are their own)."""
    starts = np.zeros(int(place.max(initial=-1)) + 1, np.uint8)
    starts[place] = 1
    return pd.DataFrame([(shard, squeezed(np.packbits(starts)), squeezed(ident), b"" if last is None else squeezed(last))], columns=_NO_STATE)


def _grams(starts: bytes, ident: bytes, last: bytes, word_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases one word longer whose first words and whose last words are frequent: places, packed numbers, last words."""
    place, ident = np.flatnonzero(np.unpackbits(unsqueezed(starts))), unsqueezed(ident)
    last = unsqueezed(last) if last else ident
    at = np.flatnonzero(np.diff(place) == 1)
    return place[at], ident[at].astype(np.uint64) << np.uint64(word_bits) | last[at + 1], last[at + 1]


def _words_of_shards(cut: DataFrame, counted: Counted) -> DataFrame:
    """The state of the frequent words, stored."""
    ids_of = counted.ids_of()

    def numbered(texts: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(texts):
            return pd.DataFrame(columns=_NO_STATE)
        text, starts = unsqueezed(texts["filter"].iloc[0]), unsqueezed(texts["starts"].iloc[0]).astype(np.int64)
        table = np.full(int(text.max(initial=0)) + 1, -1, np.int64)
        for part, places, ids in zip(known["range"], known["keys"], known["ids"]):
            table[starts[part] + 1 + unsqueezed(places)] = ids_of(ids)
        found = table[text]
        here = np.flatnonzero(found >= 0)
        return _state(texts["node"].iloc[0], here, found[here], None)

    texts = cut.where("kind = 'text'").select("node", "filter", "starts").groupBy("node")
    return stored(texts.cogroup(counted.told.groupBy("node")).applyInPandas(numbered, STATE), "phrase-state")


def _word_table(counted: Counted) -> DataFrame:
    """``id``, ``lang``, ``word``, ``f`` of the frequent words; stored."""
    ids_of = counted.ids_of()

    def table(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for keys, ids, counts in zip(batch["keys"], batch["ids"], batch["counts"]):
                words = [k.decode().split(" ", 1) for k in Words(CUT_BITS).keys(keys).to_pylist()]
                yield pd.DataFrame({"id": ids_of(ids).astype(np.int64), "lang": [w[1] for w in words], "word": [w[0] for w in words],
                                    "f": np.frombuffer(counts, np.int64)})

    return stored(counted.whole.mapInPandas(table, "id long, lang string, word string, f long"), "phrase-words")


def _filters(state: DataFrame, word_bits: int, kind: Numbers) -> DataFrame:
    """Each shard's filter of its phrases, cut into ranges; stored."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, starts, ident, last in zip(batch["shard"], batch["starts"], batch["id"], batch["last"]):
                parts = kind.cut(*quotient.counted(_grams(starts, ident, last, word_bits)[1], kind.bits), 0)
                yield pd.DataFrame([(shard, p, f) for p, f in parts], columns=["node", "range", "filter"])

    return stored(state.mapInPandas(count, FILTERS), "phrase-filters")


def _longer(state: DataFrame, nodes: int, word_bits: int, id_bits: int, least: int) -> tuple[DataFrame, DataFrame, int]:
    """From the frequent phrases of one length to those one word longer: state, table of ``id``, ``first`` (id of the
    words but the last), ``word`` (id of the last), ``f``, and the bits of an id."""
    bits = max(id_bits + word_bits, CUT_BITS * len(rounds(nodes)) + 1)
    if bits > quotient.MOST_BITS:
        raise ValueError(f"{id_bits} bits of phrases and {word_bits} bits of words do not fit into {quotient.MOST_BITS}")
    kind = Numbers(bits, CUT_BITS)
    counted = count_over_shards(_filters(state, word_bits, kind), nodes, kind, least)
    ids_of, rest, top = counted.ids_of(), np.uint64(bits - CUT_BITS), bits - CUT_BITS * counted.depth

    def advance(states: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(states) or not len(answers):
            return pd.DataFrame(columns=_NO_STATE)
        row = states.iloc[0]
        place, grams, last = _grams(row["starts"], row["id"], row["last"], word_bits)
        keys = np.concatenate([np.uint64(p) << rest | np.frombuffer(k, np.uint64) for p, k in zip(answers["range"], answers["keys"])])
        ids = np.concatenate([ids_of(i) for i in answers["ids"]])
        order = np.argsort(keys)
        keys, ids = keys[order], ids[order]
        own = quotient.permuted(grams, bits)
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        found = keys[at] == own
        return _state(row["shard"], place[found], ids[at[found]], last[found])

    def table(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, keys, ids, counts in zip(batch["range"], batch["keys"], batch["ids"], batch["counts"]):
                grams = quotient.restored(np.uint64(part << top) | np.frombuffer(keys, np.uint64), bits)
                yield pd.DataFrame({"id": ids_of(ids).astype(np.int64), "first": (grams >> np.uint64(word_bits)).astype(np.int64),
                                    "word": (grams & np.uint64((1 << word_bits) - 1)).astype(np.int64), "f": np.frombuffer(counts, np.int64)})

    told = counted.told.withColumnRenamed("node", "shard")
    next_state = state.groupBy("shard").cogroup(told.groupBy("shard")).applyInPandas(advance, STATE)
    return next_state, counted.whole.mapInPandas(table, "id long, first long, word long, f long"), counted.bits


def phrase_counts(df: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases (``lang``, ``phrase``, ``size``, ``f``; words joined by one space), single words included, and
    ``lang``, ``n``: all word occurrences. See ``collocations`` for words and pieces."""
    cut = shards(df, text, lang)
    totals = cut.where("kind = 'total'").groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0")
    nodes = cut.where("kind = 'text'").count()
    filters = cut.where("kind = 'words'").select("node", "range", "filter")
    counted = count_over_shards(filters, nodes, Words(CUT_BITS), least)
    words, word_bits = _word_table(counted), counted.bits
    level = words.select("id", "lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "f")
    found, state, id_bits = [level], _words_of_shards(cut, counted), word_bits
    names = words.select(F.col("id").alias("word"), F.col("word").alias("_word"))
    for size in range(2, longest + 1):
        state, counts, id_bits = _longer(state, nodes, word_bits, id_bits, least)
        above = found[-1].select(F.col("id").alias("first"), "lang", "phrase")
        level = stored(counts.join(above, "first").join(names, "word")
                       .select("id", "lang", F.concat_ws(" ", "phrase", "_word").alias("phrase"), F.lit(size).alias("size"), "f"), "phrases")
        if level.isEmpty():
            break
        found.append(level)
        if size < longest:
            state = stored(state, "phrase-state")
    phrases = found[0]
    for level in found[1:]:
        phrases = phrases.unionByName(level)
    return phrases.drop("id"), totals


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """``lang``, ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: each language's first ``top`` phrases.

    A-Z count as a-z. Texts are split at ``.,;:!?``, line feeds, vertical tabs, form feeds and carriage returns into pieces
    and those at spaces and tabs into words. ``n``: all word occurrences of the language; a phrase's count: its occurrences
    within pieces, overlaps included. Candidates have 2 to ``longest`` words and a count ``a`` of at least ``least`` (at
    least 1). A cut behind its first words gives ``l`` (their count), ``r`` (the rest's) and floor(1000 a n / (l r)), in
    exact decimals; the lowest cut counts, ties to the shorter first part. Candidates that lie in a longer one of the same
    count are left out. Order: score and count falling, phrase rising by bytes.

    A null language is ``und``. Null and empty texts, and texts without words, add nothing; repeated rows count as often as
    they occur; an empty table, or one without frequent phrases, gives an empty result. Other columns are not used, so
    their names do not matter. Texts of any length are split a megabyte at a time.
    """
    phrases, totals = phrase_counts(df, text, lang, max(1, least), longest)
    known = phrases.select("lang", "phrase", "f")
    several = phrases.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))
    words = several.withColumn("_w", F.split("phrase", " ")).withColumn("_k", F.explode(F.expr("sequence(1, size - 1)")))
    cuts = words.select("lang", "phrase", "a", "_k", F.array_join(F.expr("slice(_w, 1, _k)"), " ").alias("_first"),
                        F.array_join(F.expr("slice(_w, _k + 1, size)"), " ").alias("_rest"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("_first"), F.col("f").alias("l")), ["lang", "_first"]) \
        .join(known.select("lang", F.col("phrase").alias("_rest"), F.col("f").alias("r")), ["lang", "_rest"]) \
        .join(totals, "lang")
    score = F.expr("CAST(1000 AS DECIMAL(4, 0)) * CAST(a AS DECIMAL(17, 0)) * CAST(n AS DECIMAL(17, 0)) div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    best = cuts.withColumn("_score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("_score", "_k", "l", "r")).alias("_best"))
    scored = best.select("lang", "phrase", "a", "_best.l", "_best.r", "n", F.col("_best._score").cast("long").alias("score"))
    # what lies in a longer candidate of its count also lies in one that is one word longer
    longer = several.where("size > 2").withColumn("_w", F.split("phrase", " "))
    inner = F.array(F.expr("slice(_w, 1, size - 1)"), F.expr("slice(_w, 2, size - 1)"))
    covered = longer.select("lang", F.explode(inner).alias("_in"), "a").select("lang", F.array_join("_in", " ").alias("phrase"), "a").distinct()
    left = scored.join(covered, ["lang", "phrase", "a"], "left_anti")
    # a language may hold most phrases: the first of each salt, then the first of those
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    some = left.withColumn("_nth", F.row_number().over(salted)).where(F.col("_nth") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = """
WITH t AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS pieces
  FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\\x20\\x09]+') AS w FROM t),
g AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM p, (SELECT unnest(range(1, 6)) AS size)),
n AS (SELECT lang, count(*) AS n FROM g WHERE size = 1 GROUP BY lang),
f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY lang, size, phrase HAVING count(*) >= 100),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
k AS (SELECT *, unnest(range(1, size)) AS k FROM c),
s AS (
  SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r, n.n,
    CAST(CAST(1000 AS HUGEINT) * k.a * n.n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[1:k.k], ' ')
  JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[k.k + 1:], ' ') JOIN n ON n.lang = k.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covered AS (
  SELECT lang, array_to_string(w[1:size - 1], ' ') AS phrase, a FROM c WHERE size > 2
  UNION SELECT lang, array_to_string(w[2:], ' ') AS phrase, a FROM c WHERE size > 2),
o AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM b WHERE NOT EXISTS (SELECT 1 FROM covered WHERE covered.lang = b.lang AND covered.phrase = b.phrase AND covered.a = b.a))
SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= 2000
"""
