"""Phrase collocations against brute force; the counting quotient filter against plain counts."""

import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from goldspan.llm import phrases, quotient  # noqa: E402

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, least, longest, top):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    out = {}
    frequent = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    for (lang, words), a in frequent.items():
        inside = any(m == lang and len(other) > len(words) and b >= a and any(other[i:i + len(words)] == words for i in range(len(other)))
                     for (m, other), b in frequent.items())
        if not inside:
            cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return sorted((lang, i + 1, w.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, w, l, r) in enumerate(sorted(found)[:top]))


def texts(seed=1):
    rng = np.random.default_rng(seed)
    words = ["a", "B", "Ünder", "ünder", "é x", "c\x1fd", "0", "日本", "e\tf", "G.H"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 30))) + rng.choice([".", "\r\n", "\x0b x", ""]), rng.choice(["en", "de"])) for i in range(120)]
    rows = [(i, t, str(lang)) for i, t, lang in rows]
    return rows + [(5, rows[5][1], rows[5][2])] * 4 + [(200, None, "en"), (201, "", None), (202, "a b a b a b", None), (None, "a a a a a", "und"),
                                                      (203, " \t ", "fr"), (204, "b a " * 400, "en"), (205, ".,;:!?" * 9, "en")]


@pytest.mark.parametrize("shard_chars, fan", [(1 << 20, 8), (150, 2), (400, 3)])
def test_same_as_brute_force(spark, monkeypatch, shard_chars, fan):
    """Also with many shards, whose filters take several rounds to merge."""
    monkeypatch.setattr(phrases, "SHARD_CHARS", shard_chars)
    monkeypatch.setattr(phrases, "CUT_BITS", fan)
    monkeypatch.setattr(phrases, "TEXTS", 3)
    rows = texts()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS shard", "2 AS phrase", "3 AS f", "4 AS node")
    got = sorted(tuple(r) for r in phrases.collocations(df, least=6, longest=4, top=25).collect())
    want = brute(rows, 6, 4, 25)
    assert got == want and len(want) > 40


def test_texts_are_split_between_words(monkeypatch):
    text = "Aé b.c  d\te,f\x0bg" * 50 + "x" * 300
    whole, parts = phrases._Numbered({b".": 0}), phrases._Numbered({b".": 0})
    want = np.concatenate(list(phrases.word_numbers(text, whole)))
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 7)
    found = list(phrases.word_numbers(text, parts))
    assert len(found) > 20 and (np.concatenate(found) == want).all() and whole == parts
    assert [list(x) for x in phrases.word_numbers(None, whole)] == [[0]]


def test_filters_of_words():
    kind = phrases.Words(2)
    keys = pa.array([w.encode() for w in ("a en", "b\n en", "é \n", "a de", " ", "")])
    counts = np.array([1, 2, 300, 1 << 40, 5, 6])
    back = kind.unpacked(kind.packed(keys, counts))
    assert back[0].equals(keys) and (back[1] == counts).all()
    parts = [kind.unpacked(f) for _, f in kind.cut(keys, counts, 1)]
    merged = kind.merged([*parts, (keys, counts)])
    assert dict(zip(merged[0].to_pylist(), merged[1])) == dict(zip(keys.to_pylist(), 2 * counts))
    held, blob = kind.told(keys, pa.array([b"x", b"a de", b"", b"a en"]), True)
    assert list(held) == [True, False, False, True, False, True] and list(phrases.unsqueezed(blob)) == [3, 1, 2]


def test_nothing_to_find(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert phrases.collocations(none).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert phrases.collocations(none).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, None, None), (2, "a b c", "en")], SCHEMA)).count() == 0


def test_counts_beyond_64_bits_of_product(spark, monkeypatch):
    """1000 a n passes 2^63; the score is exact."""
    df = spark.createDataFrame([("en", "x", 1, 3 * 10 ** 9), ("en", "y", 1, 10 ** 9 + 1), ("en", "x y", 2, 10 ** 9)], "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("en", 4 * 10 ** 12 + 7)], "lang string, n long")
    monkeypatch.setattr(phrases, "phrase_counts", lambda *a: (df, totals))
    got = phrases.collocations(df).collect()
    assert [r["score"] for r in got] == [1000 * 10 ** 9 * (4 * 10 ** 12 + 7) // (3 * 10 ** 9 * (10 ** 9 + 1))]


@pytest.mark.parametrize("bits", [1, 2, 7, 20, 33, 47, 62])
def test_quotient_filter(bits):
    rng = np.random.default_rng(bits)
    keys = rng.integers(0, 1 << bits, 3000, dtype=np.uint64)
    mixed = quotient.permuted(keys, bits)
    assert (mixed < np.uint64(1 << bits)).all() and (quotient.restored(mixed, bits) == keys).all()
    if bits < 12:
        every = np.arange(1 << bits, dtype=np.uint64)
        assert sorted(quotient.permuted(every, bits)) == list(every)
    own, counts = quotient.counted(keys, bits)
    counts = counts + np.where(np.arange(len(counts)) % 5 == 0, 254, 0) + np.where(np.arange(len(counts)) % 7 == 0, 1 << 40, 0)
    blob = quotient.packed(own, counts, bits)
    back, again = quotient.unpacked(blob)
    assert (back == own).all() and (again == counts).all()
    half = [(own[i::2], counts[i::2]) for i in range(2)]
    both, added = quotient.merged([*half, (own, counts)])
    assert (both == own).all() and (added == 2 * counts).all()
    cut_bits = min(bits, 3)
    parts = [(np.uint64(p << bits - cut_bits) | k, c) for p, f in quotient.cut(own, counts, bits, cut_bits) for k, c in [quotient.unpacked(f)]]
    assert (np.concatenate([p[0] for p in parts]) == own).all() and (np.concatenate([p[1] for p in parts]) == counts).all()
    empty = quotient.packed(own[:0], counts[:0], bits)
    assert len(quotient.unpacked(empty)[0]) == 0 and quotient.cut(own[:0], counts[:0], bits, cut_bits) == []
