"""BPE encoding by walking a trie of the distinct words, and decoding.

A BPE encoding is fixed by the last token of every prefix: the token that ends
the encoding of a prefix, together with the encoding of what precedes it, gives
the prefix's encoding. Whether a token can stand behind another is a property
of the two alone. So the last token of a prefix follows from those of its
shorter prefixes, words that share a prefix share that work, and a depth-first
walk over the trie of all words finds it once per trie node.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldspan.llm.kept import kept
from goldspan.llm.vocabulary import UnitMemo, Vocabulary, strides, vocabulary

class TrieEncoder:
    """Encodes texts with the vocabulary; keeps the ids of recent units."""

    def __init__(self, words: Vocabulary):
        self.words = words
        self.memo = UnitMemo(self.units)
        self._follows: dict[int, bool] = {}

    def follows(self, a: int, b: int) -> bool:
        """Whether merging the bytes of ``a`` and ``b`` together gives just these two tokens.

        Their own merges are undone, latest first. In between, the two tokens at
        the border must have no merge that would have come before the next one
        undone; among equal merges the left one comes first.
        """
        rank, parts, pair_rank = self.words.rank, self.words.parts, self.words.pair_rank
        left, right, limit, stays = a, b, float("inf"), True
        while True:
            if pair_rank.get((left, right), limit) < limit:
                stays = False
                break
            if rank[left] > rank[right]:
                limit, left = rank[left], parts[left][1]
            elif rank[right] >= 0:
                limit, right = rank[right] + 0.5, parts[right][0]
            else:
                break
        if len(self._follows) >= 2_000_000:
            self._follows.clear()
        self._follows[a * len(rank) + b] = stays
        return stays

    def walk(self, distinct: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Each word with its ids, in depth-first order of the trie of all words.

        The sorted words are that trie: a word's node hangs below the longest
        prefix it shares with the word before. ``last`` is the path to the
        current node: ``last[i]`` is the last token of the prefix of length i.
        """
        token_of, lengths_by_end, size = self.words.id_of.get, self.words.lengths_by_end, len(self.words.bytes_of)
        known, follows, bytes_of = self._follows.get, self.follows, self.words.bytes_of
        last: list[int] = [-1]
        before = b""
        for word in sorted(distinct):
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                for length in lengths_by_end.get(word[max(0, end - 3):end], (2,)):
                    start = end - length
                    if start < 0 or (token := token_of(word[start:end])) is None:
                        continue
                    if start == 0:
                        break
                    stays = known(last[start] * size + token)
                    if stays or stays is None and follows(last[start], token):
                        break
                else:  # exactly one token ends a prefix, so what is left is the single byte
                    token = token_of(word[end - 1:end])
                    if token is None:
                        raise ValueError(f"the vocabulary has no byte {word[end - 1]}")
                last.append(token)
            before = word
            ids, end = [], len(word)
            while end:
                ids.append(last[end])
                end -= len(bytes_of[last[end]])
            yield word, ids[::-1]

    def units(self, distinct: list[str]) -> list[bytes]:
        """The ids of each unit as little-endian unsigned 32-bit numbers."""
        cut = [self.words.pieces(unit) for unit in distinct]
        found: dict[str | int, bytes] = {}
        new = {p for pieces in cut for p in pieces}
        spelled = {p.encode(): p for p in new if isinstance(p, str)}
        found.update((p, np.array([p], "<u4").tobytes()) for p in new if isinstance(p, int))
        for word, ids in self.walk(spelled):
            found[spelled[word]] = struct.pack(f"<{len(ids)}I", *ids)
        return [b"".join(map(found.__getitem__, pieces)) for pieces in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        return [first + b"".join(rest) for first, rest in self.memo.values(texts)]


def encoder(path: str) -> TrieEncoder:
    """The worker's encoder for this file; its memo outlives a task."""
    return kept(("encoder", path), lambda: TrieEncoder(vocabulary(path)))


class Decoder:
    """Ids back to text; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""

    def __init__(self, words: Vocabulary):
        self.sizes = np.array([len(b) for b in words.bytes_of] or [0], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(words.bytes_of), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        ids = ids[(ids >= 0) & (ids < len(self.sizes))]
        found = []
        for at in range(0, len(ids), 1 << 18):  # bounds the index arrays of a very long text
            part = ids[at:at + (1 << 18)]
            sizes = self.sizes[part]
            ends = np.cumsum(sizes)
            if len(part):
                index = np.arange(ends[-1]) + np.repeat(self.starts[part] - ends + sizes, sizes)
                found.append(self.flat[index].tobytes())
        return b"".join(found).decode("utf-8", errors="replace")


def _ids_array(coded: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), np.int32)))


def _with(batch: pa.RecordBatch, start: int, end: int, schema: pa.Schema, *new: pa.Array) -> pa.RecordBatch:
    part = batch.slice(start, end - start)
    return pa.RecordBatch.from_arrays([*part.columns, *new], names=[*batch.schema.names, *schema])


def encode_texts(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with the token ids of the whole ``text`` as ``ids`` (array of int); one narrow pass, no shuffle.

    With ``decoded``, also the text that the ids give back. A null text counts
    as empty and has no ids. Special strings of the file become their ids, as
    the library does by default. Rows, also repeated ones, are independent;
    an empty table gives an empty one. ``ids`` and ``decoded`` must be new names.
    """
    new = [ids] + ([decoded] if decoded else [])
    if clash := [c for c in df.columns if c.lower() in {n.lower() for n in new}]:
        raise ValueError(f"the table has columns {clash} already")
    schema = T.StructType([*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
                          + ([T.StructField(decoded, T.StringType())] if decoded else []))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = encoder(path)
        back = Decoder(trie.words) if decoded else None
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text)).to_pylist()
            for start, end in strides(texts):
                found = trie.encode([t or "" for t in texts[start:end]])
                columns = [_ids_array(found)]
                if back:
                    columns.append(pa.array([back.decode(np.frombuffer(f, "<i4")) for f in found], pa.string()))
                yield _with(batch, start, end, new, *columns)

    return df.mapInArrow(coded, schema)


def decode_ids(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of the token ids in ``ids`` as ``text``; null ids give a null text."""
    schema = T.StructType([*df.schema.fields, T.StructField(text, T.StringType())])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = kept(("decoder", path), lambda: Decoder(vocabulary(path)))
        for batch in batches:
            column = batch.column(batch.schema.names.index(ids))
            found = [None if x is None else back.decode(np.array(x, np.int64)) for x in column.to_pylist()]
            yield _with(batch, 0, batch.num_rows, [text], pa.array(found, pa.string()))

    return df.mapInArrow(texts, schema)


def digests(df: DataFrame) -> DataFrame:
    """Of an encoded table: ``doc_id``, ``n_tokens`` and hashes of the ids and of the text they give back."""
    return df.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
