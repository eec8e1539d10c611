"""Text predicates. A token is a run of letters and digits, lower-cased.

Token tests are regular expressions over the lower-cased text, not array
functions over its tokens: nothing is allocated per token, and the whole test
stays in generated code.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

_INNER = r"[\p{L}\p{N}]"
BREAKS = r"[^\p{L}\p{N}]+"
_CLAUSE = re.compile(r'([+-]?)(?:"([^"]*)"|(\S+))')


def tokens(text: Column) -> Column:
    # array_remove, unlike filter with a lambda, stays in generated code
    return F.array_remove(F.split(F.lower(text), BREAKS), "")


def query_tokens(text: str) -> list[str]:
    """The tokens of a query text, in order."""
    return re.findall(r"[^\W_]+", text.lower())


def _occurs(words: list[str], open_end: bool = False) -> str:
    """Pattern of consecutive whole tokens; with an open end the last is a prefix.

    The text before a token is looked at after the token itself matched, so
    the search skips along on the token's first letter. Tokens hold letters
    and digits only: nothing needs escaping.
    """
    first, *rest = words
    pattern = f"{first}(?<!{_INNER}{first})" + "".join(BREAKS + w for w in rest)
    return pattern if open_end else pattern + f"(?!{_INNER})"


def has_any_token(text: Column, query: str) -> Column:
    wanted = list(dict.fromkeys(query_tokens(query)))
    if not wanted:
        return F.lit(False)
    return F.lower(text).rlike("|".join(_occurs([w]) for w in wanted))


def has_all_tokens(text: Column, query: str) -> Column:
    wanted = list(dict.fromkeys(query_tokens(query)))
    if not wanted:
        return F.lit(False)
    return reduce(and_, [F.lower(text).rlike(_occurs([w])) for w in wanted])


def close_to(text: Column, value: str, max_edits: int = 2) -> Column:
    """Edit distance at most ``max_edits``; lengths too far apart skip the work.

    The bounded form of levenshtein returns -1 beyond its bound.
    """
    near = F.abs(F.length(text) - F.lit(len(value))) <= max_edits
    return near & (F.levenshtein(text, F.lit(value), max_edits) >= 0)


def wildcard(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    """``*`` is any run and ``?`` one character; the whole value must match.

    LIKE is used, not a regular expression: Catalyst turns ``abc%`` into a
    prefix test that reaches the parquet scan.
    """
    like = re.sub(r"([\\%_])", r"\\\1", pattern).replace("*", "%").replace("?", "_")
    return text.ilike(like) if ignore_case else text.like(like)


def query_string(text: Column, query: str) -> Column:
    """``t`` optional, ``+t`` needed, ``-t`` refused, ``"a b"`` phrase, ``t*`` prefix.

    Optional terms decide (at least one) only when no term is needed. A query
    of refusals alone matches whatever avoids them; an empty one matches nothing.
    """
    needed, refused, optional = [], [], []
    for sign, phrase, word in _CLAUSE.findall(query):
        words = query_tokens(phrase or word)
        if words:
            pattern = _occurs(words, open_end=not phrase and word.endswith("*"))
            {"+": needed, "-": refused, "": optional}[sign].append(pattern)
    lowered = F.lower(text)
    tests = [lowered.rlike(p) for p in needed] + [~lowered.rlike(p) for p in refused]
    if optional and not needed:
        tests.append(lowered.rlike("|".join(optional)))
    return reduce(and_, tests) if tests else F.lit(False)
