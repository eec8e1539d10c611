"""Token counts of whole texts; huge ones chunk by chunk, with overlaps that prove where the chunks meet."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Encoding, Tokenizer

from goldspan.llm.kept import kept
from goldspan.llm.vocabulary import UnitMemo, Vocabulary, strides, vocabulary

CHUNK = 32_768
OVERLAP = 256


class ChunkCounter:
    """Counts a text's tokens from encodings of overlapping chunks.

    A chunk that starts inside the text may be cut wrongly at first, and one
    that ends inside it may be cut wrongly at last. But the pattern that cuts
    text into pieces looks only ahead. So where the earlier chunk, far enough
    from its end, has a piece border, that border is real, and if the later
    chunk has a border there as well, all that the later one has from there on
    is real too. At such a border the two are spliced. If the overlap has none,
    it is doubled, back to the last splice if need be; from there the chunk
    itself grows, so a text without any border is encoded as one chunk.
    """

    def __init__(self, words: Vocabulary, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.library, self.chunk, self.overlap = words.library, chunk, overlap
        # a special string that the chunk's end cuts, or the character a look-ahead needs
        self.margin = max([1, *map(len, words.special)])
        self.special = set(words.special.values())

    def borders(self, found: Encoding, start: int) -> dict[int, int]:
        """Places in the text where a piece begins, with the number of the chunk's tokens before it."""
        at, before = {}, object()
        for i, (word, token, (place, _)) in enumerate(zip(found.word_ids, found.ids, found.offsets)):
            if word != before or token in self.special:
                at[start + place] = i
            before = word
        return at

    def count(self, text: str) -> int:
        done, start, end = 0, 0, min(len(text), self.chunk)
        found = self.library.encode(text[:end], add_special_tokens=False)
        here, proven, skipped = self.borders(found, 0), 0, 0  # proven: the last splice; skipped: the chunk's tokens before it
        overlap = self.overlap
        while end < len(text):
            from_ = max(proven, end - overlap)
            to = min(len(text), max(end, from_ + self.chunk) + (overlap if from_ == proven else 0))
            later = self.library.encode(text[from_:to], add_special_tokens=False)
            there = self.borders(later, from_)
            meet = [p for p in there if p in here and max(from_, proven) < p <= end - self.margin]
            if from_ == proven:  # starts at a splice, so all of it is real: it takes this chunk's place
                found, here, start, end, skipped = later, there, from_, to, 0
                overlap *= 2
            elif meet:
                place = max(meet)
                done += here[place] - skipped
                found, here, start, end = later, there, from_, to
                proven, skipped, overlap = place, there[place], self.overlap
            else:
                overlap *= 2
        return done + len(found.ids) - skipped


def _single_threaded() -> None:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
    os.environ["RAYON_NUM_THREADS"] = "1"


class LibraryCounter:
    """Counts with the library of the file: by units and chunks where the file allows it, else whole texts."""

    def __init__(self, path: str):
        _single_threaded()
        self.memo = self.chunks = None
        if path.endswith(".model"):
            import sentencepiece
            pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
            return
        try:
            words = vocabulary(path)
        except ValueError:  # another kind of file: its texts cannot be cut at spaces
            library = Tokenizer.from_file(path)
            library.no_truncation()
            library.no_padding()
        else:
            library, self.memo, self.chunks = words.library, UnitMemo(self.units), ChunkCounter(words)
        self.library = library
        self.whole = self.units

    def units(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        if not self.memo:
            return self.whole(texts)
        found = {i: self.chunks.count(t) for i, t in enumerate(texts) if len(t) > self.chunks.chunk}
        short = [i for i in range(len(texts)) if i not in found]
        for i, (first, rest) in zip(short, self.memo.values([texts[i] for i in short])):
            found[i] = first + sum(rest)
        return [found[i] for i in range(len(texts))]


def count_tokens(df: DataFrame, path: str, text: str = "text", n_tokens: str = "n_tokens") -> DataFrame:
    """``df`` with the number of tokens of the whole ``text`` as ``n_tokens``; one narrow pass, no shuffle.

    ``path`` is a ``.json`` file of the tokenizers library or a ``.model`` file
    of sentencepiece. No begin, end or other special tokens are added; special
    strings inside texts count as the library takes them by default. A null
    text counts as empty: 0 tokens. Rows, also repeated ones, are independent;
    an empty table gives an empty one. ``n_tokens`` must be a new name.
    """
    if n_tokens.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table has a column {n_tokens} already")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _single_threaded()
        counter = kept(("counter", path), lambda: LibraryCounter(path))
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text)).to_pylist()
            found: list[int] = []
            for start, end in strides(texts):
                found += counter.count([t or "" for t in texts[start:end]])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names=[*batch.schema.names, n_tokens])

    return df.mapInArrow(counted, T.StructType([*df.schema.fields, T.StructField(n_tokens, T.LongType())]))


def sizes(df: DataFrame, path: str, limit: int) -> DataFrame:
    """``doc_id``, UTF-8 bytes, tokens, and whether there are more than ``limit``."""
    # the byte count is taken before Python, so that the text does not come back from there
    measured = df.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "text")
    return count_tokens(measured, path).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
