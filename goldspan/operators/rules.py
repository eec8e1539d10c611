"""Rejection rules. A rule *fires*, and rejects the record, when its condition is true.

A null field fires only the rules that ask for emptiness or for a lookup hit
(an absent value is not found); the others leave it alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldspan.functions import taxid

EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"

_COMPARE: dict[str, Callable[[Column, Any], Column]] = {
    "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b, ">=": lambda a, b: a >= b, ">": lambda a, b: a > b,
}


@dataclass(frozen=True)
class Rule:
    """``name`` from RULES on one field (or a field list for LOOKUP_MULTIPLE).

    ``negate`` turns the test round: MATCHES and IS_EMAIL are often meant as
    "must match".
    """
    name: str
    field: str | tuple[str, ...]
    params: tuple = ()
    negate: bool = False
    label: str | None = None
    table: DataFrame | None = field(default=None, compare=False)

    @property
    def error(self) -> str:
        where = self.field if isinstance(self.field, str) else "+".join(self.field)
        return self.label or f"{self.name}:{where}"


def _is_empty(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def _state_tax_id(c: Column, state: str) -> Column:
    return ~taxid.state_tax_id_length_ok(c, F.col(state))


def _value_compare(c: Column, op: str, other: Any, is_field: bool = False) -> Column:
    return _COMPARE[op](c, F.col(other) if is_field else F.lit(other))


RULES: dict[str, Callable[..., Column]] = {
    "CONTAINS": lambda c, text: c.contains(text),
    "CONTAINS_ARRAY": lambda c, texts: reduce(or_, [c.contains(t) for t in texts], F.lit(False)),
    "STARTS_WITH": lambda c, text: c.startswith(text),
    "ENDS_WITH": lambda c, text: c.endswith(text),
    "EQUALS": lambda c, value: c == F.lit(value),
    "MATCHES": lambda c, pattern: c.rlike(pattern),
    "IS_EMPTY": _is_empty,
    "IS_EMAIL": lambda c: c.rlike(EMAIL),
    "LENGTH_COMPARE": lambda c, op, n: _COMPARE[op](F.length(c), F.lit(n)),
    "LENGTH_RANGE": lambda c, low, high: ~F.length(c).between(low, high),
    "IS_NOT_NUMBER_ONLY": lambda c: ~c.rlike("^[0-9]+$"),
    "IS_INVALID_BRAZIL_TAX_ID": lambda c: ~taxid.tax_id_ok(c),
    "IS_INVALID_BRAZIL_STATE_TAX_ID": _state_tax_id,
    "VALUE_COMPARE": _value_compare,
}
LOOKUPS = {"LOOKUP", "LOOKUP_MULTIPLE", "LOOKUP_FOUND"}


def fires(rule: Rule) -> Column:
    """The rule's condition; never null. Lookups need the table: see ``with_lookups``."""
    test = RULES[rule.name](F.col(rule.field), *rule.params)
    if rule.name in ("IS_INVALID_BRAZIL_TAX_ID", "IS_INVALID_BRAZIL_STATE_TAX_ID"):
        test = F.col(rule.field).isNotNull() & test
    if rule.negate:
        test = ~test
    return F.coalesce(test, F.lit(False))


def _lookup_fields(rule: Rule) -> tuple[Sequence[str], Sequence[str]]:
    mine = [rule.field] if isinstance(rule.field, str) else list(rule.field)
    theirs = rule.params[0] if rule.params else mine
    return mine, [theirs] if isinstance(theirs, str) else list(theirs)


def with_lookups(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, dict[int, Column]]:
    """``df`` with one found flag per lookup rule, and the condition each flag gives.

    The lookup keys are made distinct, so the left join keeps the row count;
    whether they are broadcast is left to Spark's check of their size. With a
    shuffled join, adaptive execution splits a value that very many records share.
    """
    conditions = {}
    for i, rule in enumerate(rules):
        if rule.name not in LOOKUPS:
            continue
        mine, theirs = _lookup_fields(rule)
        names = [f"_lookup{i}_{j}" for j in range(len(mine))]
        flag = f"_lookup{i}"
        keys = rule.table.select(*[F.col(t).alias(n) for t, n in zip(theirs, names)]).dropna().distinct()
        on = [F.col(m) == F.col(n) for m, n in zip(mine, names)]
        df = df.join(keys.withColumn(flag, F.lit(True)), on, "left").drop(*names)
        found = F.col(flag).isNotNull()
        conditions[i] = found if (rule.name == "LOOKUP_FOUND") != rule.negate else ~found
    return df, conditions


def errors_of(df: DataFrame, rules: Sequence[Rule], errors: str = "mdmErrors") -> DataFrame:
    """``df`` with the list of rules that fired, in rule order, in one pass.

    Errors a record already has, such as bad types, stay in front.
    """
    columns = [c for c in df.columns if c != errors]
    joined, looked_up = with_lookups(df, rules)
    nothing = F.array().cast("array<string>")
    parts = [F.col(errors)] if errors in df.columns else []
    parts += [
        F.when(looked_up[i] if i in looked_up else fires(rule), F.array(F.lit(rule.error))).otherwise(nothing)
        for i, rule in enumerate(rules)
    ]
    return joined.select(*[F.col(f"`{c}`") for c in columns], F.concat(nothing, *parts).alias(errors))
