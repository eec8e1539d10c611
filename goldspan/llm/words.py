"""Words and word windows of texts as hash arrays, and the exchange that finds which hashes repeat."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldspan.llm.kept import kept
from goldspan.session import stored

ODD = np.uint64(0x9E3779B97F4A7C15)
SHIFT = np.uint64(29)


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """The runs between white space (space, tab to carriage return) as UTF-8; ``lower`` changes A-Z only."""
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


class WordHashes(dict):
    """64-bit hashes of words, kept between tasks; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(kept("word hashes", WordHashes).__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = x ^ (x >> SHIFT)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(32))
    return x * np.uint64(0x94D049BB133111EB) ^ (x >> SHIFT)


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each place on (shorter than ``hashes`` by length - 1)."""
    many = max(0, len(hashes) - length + 1)
    found = np.zeros(many, np.uint64)
    for i in range(length):
        found = found * ODD + hashes[i:i + many]
    return mix(found)


def slabs_for(df: DataFrame, text: str, slab_bytes: int) -> tuple[int, int]:
    """Number of documents, and of slabs of about ``slab_bytes`` of text (one per shuffle partition at least)."""
    found = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(text))).first()
    return found[0], max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(found[1] or 0) // slab_bytes))


def bucket_and_key(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash's bucket, and the 32 bits that tell it from others of the bucket."""
    return (hashes & np.uint64(0xFFFFFFFF)).astype(np.int64) % buckets, (hashes >> np.uint64(32)).astype(np.uint32)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before (the first one does)."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


SENT = "bucket int, slab int, keys binary, slabs binary, known binary"


def send(hashes: np.ndarray, docs: np.ndarray, slabs: np.ndarray, buckets: int) -> Iterator[dict]:
    """Rows that tell the buckets which hashes a batch holds. ``docs`` and ``slabs``: of each hash.

    A hash in several of the batch's documents is known to repeat: the bucket
    gets it once, however many documents hold it, and the slabs that need the
    answer get it by rows of their own (bucket of the slab's number, ``slab`` set).
    """
    bucket, key = bucket_and_key(hashes, buckets)
    order = np.lexsort((docs, key, bucket))
    bucket, key, docs, slabs = bucket[order], key[order], docs[order], slabs[order]
    new = _runs(bucket, key)
    start = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    many = np.zeros(len(start), bool)
    many[run[~new & _runs(docs)]] = True  # another document within the run
    b, k, s, m = bucket[start], key[start], slabs[start].astype(np.uint32), many
    for at, end in _ranges(b):
        yield {"bucket": int(b[at]), "slab": -1, "keys": k[at:end].tobytes(), "slabs": s[at:end].tobytes(), "known": m[at:end].tobytes()}
    told = many[run]
    code = np.unique(np.stack([slabs[told].astype(np.int64), bucket[told] << 32 | key[told].astype(np.int64)], 1), axis=0)
    for at, end in _ranges(code[:, 0]):
        slab = int(code[at, 0])
        yield {"bucket": slab % buckets, "slab": slab, "keys": code[at:end, 1].tobytes(), "slabs": b"", "known": b""}


def _ranges(sorted_: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(_runs(sorted_)) if len(sorted_) else np.zeros(0, int)
    yield from zip(edges.tolist(), [*edges[1:].tolist(), len(sorted_)])


def repeated(sent: DataFrame, buckets: int, label: str) -> DataFrame:
    """Of rows made by ``send``: which hashes are in several documents, for each slab that holds them.

    ``slab``, ``codes`` (bucket and key as one 64-bit number each). Keys have 32
    bits within a bucket, so now and then a hash is reported that does not
    repeat; one that repeats always is. The result is stored.
    """
    def find(rows: pd.DataFrame) -> pd.DataFrame:
        out = [(int(s), k) for s, k in zip(rows["slab"], rows["keys"]) if s >= 0]
        own = rows[rows["slab"] < 0]
        if len(own):
            bucket = int(own["bucket"].iloc[0])
            key = np.frombuffer(b"".join(own["keys"]), np.uint32)
            slab = np.frombuffer(b"".join(own["slabs"]), np.uint32).astype(np.int64)
            known = np.frombuffer(b"".join(own["known"]), bool)
            order = np.argsort(key, kind="stable")
            key, slab, known = key[order], slab[order], known[order]
            new = _runs(key)
            run = np.cumsum(new) - 1
            many = np.bincount(run) > 1
            many[run[known]] = True
            # the slabs of a known one have been told
            told = many[run] & ~known
            pairs = np.unique(np.stack([slab[told], np.int64(bucket) << 32 | key[told].astype(np.int64)], 1), axis=0)
            out += [(int(pairs[at, 0]), pairs[at:end, 1].tobytes()) for at, end in _ranges(pairs[:, 0])]
        return pd.DataFrame(out, columns=["slab", "codes"])

    return stored(sent.groupBy("bucket").applyInPandas(find, "slab int, codes binary"), label)


def is_told(hashes: np.ndarray, codes: np.ndarray, buckets: int) -> np.ndarray:
    """Whether the sorted ``codes`` of a slab hold these hashes."""
    bucket, key = bucket_and_key(hashes, buckets)
    code = bucket << 32 | key.astype(np.int64)
    at = np.searchsorted(codes, code)
    return np.concatenate([codes, [-1]])[at] == code if len(codes) else np.zeros(len(hashes), bool)


def codes_of(rows) -> np.ndarray:
    return np.sort(np.frombuffer(b"".join(rows), np.int64))
