"""A byte-level BPE vocabulary file, and how text falls into independent units.

A *unit* is what lies between two spaces that are each followed by a visible
character. The file's splitting pattern always has a border in front of such a
space, so a text's ids are the ids of its units put together, and a unit is
encoded once however often it occurs.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Any
from weakref import WeakValueDictionary

import regex
from tokenizers import Tokenizer

# Fixed value: the pattern with which this kind of file splits text before merging.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

# Characters on whose class all Unicode versions agree; units with others are split by the library itself.
PLAIN = re.compile("[\x00-ɏ‐-‧‰-‾€一-龥]*")

# A space that does not open a unit: more white space, or the end of the text, follows.
IDLE_SPACE = re.compile(r" (?:\s|\Z)")
OPENING_SPACE = re.compile(r" (?=\S)")


def unit_parts(text: str) -> list[str]:
    """The units of ``text``: the first as it is, each later one without the space that opens it."""
    return OPENING_SPACE.split(text) if IDLE_SPACE.search(text) else text.split(" ")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the file: itself where it can be printed, else the
    next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and special strings of a byte-level BPE file.

    ``rank[t]`` is the place of the merge that makes token ``t`` (-1: a single
    byte) and ``parts[t]`` the two tokens it merges. Files in which a token has
    several merges, or with a normalizer, are refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model, cut = said["model"], said.get("pre_tokenizer") or {}
        if (model.get("type") != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space")
                or not cut.get("use_regex", True) or said.get("normalizer") or model.get("ignore_merges")):
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        self.path = path
        alphabet = byte_alphabet()
        self.special = {t["content"]: t["id"] for t in said.get("added_tokens", [])}
        raw = {text: bytes(alphabet[c] for c in text) for text in model["vocab"] if text not in self.special}
        self.id_of = {raw[text]: i for text, i in model["vocab"].items() if text in raw}
        size = max([*model["vocab"].values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for text, i in [*((raw[t], model["vocab"][t]) for t in raw), *((s.encode(), i) for s, i in self.special.items())]:
            self.bytes_of[i] = text
        self.rank, self.parts, self.pair_rank = [-1] * size, [None] * size, {}
        for place, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b = self.id_of[raw[left]], self.id_of[raw[right]]
            whole = self.id_of[raw[left] + raw[right]]
            if self.parts[whole] is not None:
                raise ValueError(f"{path}: two merges make token {whole}")
            self.rank[whole], self.parts[whole], self.pair_rank[a, b] = place, (a, b), place
        ends: dict[bytes, set[int]] = {}
        for token in self.id_of:
            ends.setdefault(token[-3:], set()).add(len(token))
        # by a token's last three bytes: the lengths of tokens that end so, longest first. Those of two bytes count
        # for every ending they are part of; a prefix whose ending is not listed has no longer token than they are.
        self.lengths_by_end = {end: sorted(sizes | ({2} if end[-2:] in self.id_of else set()), reverse=True)
                               for end, sizes in ends.items() if len(end) > 1}
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self._special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None

    def pieces(self, unit: str) -> list[str | int]:
        """The words of a unit as the file's pattern cuts them; special strings as their ids."""
        found: list[str | int] = []
        for text in self._special.split(unit) if self._special else [unit]:
            if text in self.special:
                found.append(self.special[text])
            elif PLAIN.fullmatch(text):
                found += PIECE.findall(text)
            else:
                found += [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return found


_in_use: WeakValueDictionary[str, Vocabulary] = WeakValueDictionary()


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of ``path``, read once as long as the worker uses it. ``path`` must be installed on every executor."""
    found = _in_use.get(path)
    if found is None:
        found = _in_use[path] = Vocabulary(path)
    return found


class UnitMemo:
    """Looks up texts unit by unit; ``code`` works out the values of distinct units it has not kept.

    Units seen in several batches move to a lasting part, so that the many units
    that occur once push out only each other. Both parts are bounded.
    """

    LASTING, YOUNG = 400_000, 250_000

    def __init__(self, code: Callable[[list[str]], list[Any]]):
        self.code = code
        self.lasting: dict[str, Any] = {}
        self.young: dict[str, Any] = {}

    def values(self, texts: list[str]) -> Iterator[tuple[Any, map]]:
        """Of each text: the value of its first unit, and those of the others in order."""
        parts = [unit_parts(t) for t in texts]
        first = [p.pop(0) for p in parts]
        needed = set().union(*parts)
        new = list(needed - self.lasting.keys() - self.young.keys())
        known = {u: self.young.pop(u) for u in needed & self.young.keys()}
        if len(self.lasting) + len(known) > self.LASTING:
            self.lasting = {u: self.lasting[u] for u in needed & self.lasting.keys()}
        self.lasting.update(known)
        opening = list(set(first))
        coded = self.code([" " + u for u in new] + opening)
        bare = dict(zip(opening, coded[len(new):]))
        if len(self.young) + len(new) > self.YOUNG:
            self.young = {}
        self.young.update(zip(new, coded))
        here = {u: v for part in (self.lasting, self.young) for u in needed & part.keys() for v in (part[u],)}
        for f, p in zip(first, parts):
            yield bare[f], map(here.__getitem__, p)


# Characters of text that are looked up together.
STRIDE = 4 << 20


def strides(texts: list[str | None], size: int = STRIDE) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``size`` characters, so that a batch of long texts is worked off in parts."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
