"""The record filter language: JSON or Python form to Column and joins.

A search has three lists of predicates: all of ``must``, none of ``must_not``
and at least ``minimum_should_match`` of ``should`` (an empty should list asks
for nothing). A predicate on a null field never matches, so ``must_not`` keeps
records whose field is null.

Every ``NESTED_x`` predicate is ``x`` asked of the elements of an array: it
matches when some element does. NESTED_MISSING alone asks that no element has
the key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from goldspan.functions import geo, text
from goldspan.names import VALUES

Getter = Callable[[str], Column]

# The JSON name of each predicate attribute.
WIRE_NAMES = {
    "kind": "mdmFilterType",
    "key": "mdmKey",
    "value": "mdmValue",
    "path": "mdmPath",
    "range_values": "mdmRangeValues",
    "values_field": "mdmValuesField",
    "format": "mdmFormat",
    "flags": "mdmFlags",
    "range_start": "mdmRangeStart",
    "range_end": "mdmRangeEnd",
    "values_query": "mdmValuesQuery",
}


@dataclass(frozen=True)
class Predicate:
    kind: str
    key: str | None = None
    value: Any = None
    path: str | None = None
    range_values: list | None = None
    values_field: str | None = None
    format: str | None = None
    flags: Any = None
    range_start: Any = None
    range_end: Any = None
    values_query: Predicate | Search | None = None

    def __post_init__(self):
        if self.values_query is not None and self.values_field is None:
            raise ValueError("values_query needs values_field")
        if self.range_values is not None and not isinstance(self.range_values, list):
            raise ValueError("range_values must be a list")

    def under(self, prefix: str) -> Predicate:
        """The same predicate with its fields moved below ``prefix``."""
        if not prefix:
            return self
        moved = {
            name: f"{prefix}.{getattr(self, name)}"
            for name in ("key", "values_field") if getattr(self, name)
        }
        return replace(self, **moved)

    def to_wire(self) -> dict:
        wire = {}
        for name, wire_name in WIRE_NAMES.items():
            value = getattr(self, name)
            if isinstance(value, (Predicate, Search)):
                value = value.to_wire()
            if value is not None:
                wire[wire_name] = value
        return wire

    @classmethod
    def from_wire(cls, wire: Mapping) -> Predicate:
        unknown = set(wire) - set(WIRE_NAMES.values())
        if unknown:
            raise ValueError(f"unknown filter attributes: {sorted(unknown)}")
        given = {name: wire[w] for name, w in WIRE_NAMES.items() if w in wire}
        if isinstance(given.get("values_query"), Mapping):
            sub = given["values_query"]
            given["values_query"] = cls.from_wire(sub) if "mdmFilterType" in sub else Search.from_wire(sub)
        return cls(**given)


@dataclass
class Search:
    must: list[Predicate] = field(default_factory=list)
    must_not: list[Predicate] = field(default_factory=list)
    should: list[Predicate] = field(default_factory=list)
    aggregations: list = field(default_factory=list)
    minimum_should_match: int = 1
    key_prefix: str = ""

    def __post_init__(self):
        for part in ("must", "must_not", "should"):
            setattr(self, part, [p.under(self.key_prefix) for p in getattr(self, part)])

    def to_wire(self) -> dict:
        return {
            "mustList": [p.to_wire() for p in self.must],
            "mustNotList": [p.to_wire() for p in self.must_not],
            "shouldList": [p.to_wire() for p in self.should],
            "aggregationList": [a.to_wire() for a in self.aggregations],
            "minimumShouldMatch": self.minimum_should_match,
        }

    @classmethod
    def from_wire(cls, wire: Mapping) -> Search:
        from goldspan.plans.aggregations import Aggregation

        def predicates(part):
            return [Predicate.from_wire(p) for p in wire.get(part, [])]

        if "mdmFilterType" in wire:
            return cls(must=[Predicate.from_wire(wire)])
        return cls(
            must=predicates("mustList"),
            must_not=predicates("mustNotList"),
            should=predicates("shouldList"),
            aggregations=[Aggregation.from_wire(a) for a in wire.get("aggregationList", [])],
            minimum_should_match=wire.get("minimumShouldMatch", 1),
        )


def as_search(query: Search | Predicate | Mapping) -> Search:
    if isinstance(query, Search):
        return query
    if isinstance(query, Predicate):
        return Search(must=[query])
    return Search.from_wire(query)


# --- fields -----------------------------------------------------------------

def _parts(path: str) -> list[str]:
    """``a.b.raw`` -> [a, b]: ``.raw`` only names the un-analysed form."""
    parts = path.split(".")
    return parts[:-1] if len(parts) > 1 and parts[-1] == "raw" else parts


def record_getter(columns: list[str]) -> Getter:
    """Column of a dotted field. Flat tables answer enveloped names too."""
    def get(path: str) -> Column:
        parts = _parts(path)
        if parts[0] == VALUES and VALUES not in columns and len(parts) > 1:
            parts = parts[1:]
        return F.col(".".join(f"`{p}`" for p in parts))
    return get


def table_getter(df: DataFrame) -> Getter:
    """``record_getter`` of a table: an array below other arrays is one list of all its elements."""
    plain = record_getter(df.columns)

    def get(path: str) -> Column:
        column = plain(path)
        if "." not in path:
            return column
        kind = df.select(column).schema[0].dataType
        while isinstance(kind, ArrayType) and isinstance(kind.elementType, ArrayType):
            column, kind = F.flatten(F.array_compact(column)), kind.elementType
        return column
    return get


def element_getter(element: Column, path: str) -> Getter:
    def get(key: str) -> Column:
        inner = key[len(path) + 1:] if key.startswith(path + ".") else key
        return reduce(lambda c, part: c.getField(part), _parts(inner), element)
    return get


# --- predicates on one field -------------------------------------------------

_LEAVES: dict[str, Callable[[Column, Predicate], Column]] = {}


def _leaf(*kinds: str):
    def register(fn):
        for kind in kinds:
            _LEAVES[kind] = fn
        return fn
    return register


@_leaf("TERM_FILTER", "BOOL_FILTER")
def _equal(c: Column, p: Predicate) -> Column:
    return c == F.lit(p.value)


@_leaf("TERMS_FILTER")
def _member(c: Column, p: Predicate) -> Column:
    return c.isin(list(p.value))


def _bounds(p: Predicate) -> tuple[Any, Any]:
    if p.range_start is not None or p.range_end is not None:
        return p.range_start, p.range_end
    pair = p.value if p.value is not None else p.range_values
    if not isinstance(pair, (list, tuple)) or len(pair) != 2:
        raise ValueError(f"a range needs [low, high], got {pair!r}")
    return pair[0], pair[1]


@_leaf("RANGE_FILTER")
def _within(c: Column, p: Predicate) -> Column:
    """Both ends included; None leaves an end open (the field must be present)."""
    def literal(v):
        return F.to_timestamp(F.lit(v), p.format) if p.format else F.lit(v)

    low, high = _bounds(p)
    tests = [c.isNotNull()]
    if low is not None:
        tests.append(c >= literal(low))
    if high is not None:
        tests.append(c <= literal(high))
    return reduce(and_, tests)


@_leaf("MATCH_FILTER", "MATCH_ANY_TERM_FILTER")
def _any_term(c: Column, p: Predicate) -> Column:
    return text.has_any_token(c, str(p.value))


@_leaf("MATCH_ALL_TERMS_FILTER")
def _all_terms(c: Column, p: Predicate) -> Column:
    return text.has_all_tokens(c, str(p.value))


def _edits(p: Predicate) -> int:
    return (p.flags or {}).get("max_edits", 2) if isinstance(p.flags, Mapping) else 2


@_leaf("TERM_FUZZY_FILTER")
def _fuzzy(c: Column, p: Predicate) -> Column:
    return text.close_to(c, str(p.value), _edits(p))


@_leaf("TERMS_FUZZY_FILTER")
def _fuzzy_any(c: Column, p: Predicate) -> Column:
    return reduce(or_, [text.close_to(c, str(v), _edits(p)) for v in p.value], F.lit(False))


@_leaf("WILDCARD_FILTER")
def _wildcard(c: Column, p: Predicate) -> Column:
    return text.wildcard(c, str(p.value))


@_leaf("WILDCARD_CUSTOM_FILTER")
def _wildcard_flagged(c: Column, p: Predicate) -> Column:
    """Flag ``i`` (or CASE_INSENSITIVE) ignores case."""
    flags = p.flags if isinstance(p.flags, (list, tuple)) else [p.flags]
    return text.wildcard(c, str(p.value), any(f in ("i", "CASE_INSENSITIVE") for f in flags))


@_leaf("SIMPLE_QUERY_STRING")
def _query_string(c: Column, p: Predicate) -> Column:
    return text.query_string(c, str(p.value))


@_leaf("EXISTS_FILTER")
def _exists(c: Column, p: Predicate) -> Column:
    return c.isNotNull()


@_leaf("MISSING_FILTER")
def _missing(c: Column, p: Predicate) -> Column:
    return c.isNull()


@_leaf("GEODISTANCE_FILTER")
def _geodistance(c: Column, p: Predicate) -> Column:
    """Distance of a ``struct<lat, lon>`` field within [low, high] km.

    The centre is ``value`` {lat, lon}; without one, the range list carries it
    in front: [lat, lon, low, high].
    """
    span = list(p.range_values)
    if p.value is not None:
        lat, lon = p.value["lat"], p.value["lon"]
    else:
        lat, lon = span[0], span[1]
        span = span[2:]
    point = (c.getField("lat"), c.getField("lon"), float(lat), float(lon))
    exact = _within(geo.distance_km(*point), Predicate("RANGE_FILTER", value=span))
    high = _bounds(Predicate("RANGE_FILTER", value=span))[1]
    return exact if high is None else geo.band(*point, float(high)) & exact


def _nested(get: Getter, p: Predicate) -> Column:
    elements = get(p.path)
    kind = p.kind.removeprefix("NESTED_")
    if p.kind == "NESTED":
        kind = "TERM_FILTER"
    if kind == "MATCH_ALL_FILTER":
        return F.size(elements) > 0
    if kind == "MISSING_FILTER":
        found = F.exists(elements, lambda e: element_getter(e, p.path)(p.key).isNotNull())
        return ~F.coalesce(found, F.lit(False))
    test = _LEAVES[kind]
    return F.exists(elements, lambda e: test(element_getter(e, p.path)(p.key), p))


def matches(p: Predicate, get: Getter, type_column: str = "mdmEntityType") -> Column:
    """The Column of one predicate; null stands for no match."""
    if p.kind == "MATCH_ALL_FILTER":
        return F.lit(True)
    if p.kind == "TYPE_FILTER":
        return get(type_column) == F.lit(p.value)
    if p.kind.startswith("NESTED"):
        if not p.path or (p.kind != "NESTED" and p.kind.removeprefix("NESTED_") not in _KNOWN):
            raise ValueError(f"cannot evaluate {p.to_wire()}")
        return _nested(get, p)
    if p.kind not in _LEAVES:
        raise ValueError(f"unknown filter type {p.kind}")
    key = f"{p.path}.{p.key}" if p.path and not str(p.key).startswith(p.path) else p.key
    return _LEAVES[p.kind](get(key), p)


_KNOWN = set(_LEAVES) | {"MATCH_ALL_FILTER"}


def _surely(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def condition(search: Search, get: Getter, test: Callable[[Predicate], Column] | None = None) -> Column:
    """One Column for a whole search.

    ``must`` parts stay bare comparisons so that they reach the scan; null
    handling is added only where a null could flip the outcome.
    """
    test = test or (lambda p: matches(p, get))
    parts = [test(p) for p in search.must]
    parts += [~_surely(test(p)) for p in search.must_not]
    if search.should:
        tests = [test(p) for p in search.should]
        wanted = search.minimum_should_match
        if wanted == 1:
            parts.append(reduce(or_, tests))
        else:
            parts.append(reduce(lambda a, b: a + b, [_surely(t).cast("int") for t in tests]) >= wanted)
    return reduce(and_, parts, F.lit(True))


def route(search: Search, tables: Mapping[str, DataFrame] | None,
          default: DataFrame | None = None) -> tuple[DataFrame, Search]:
    """The table a required type filter names, and the search left to run on it.

    A type without a table of its own is tested on ``default``'s type column.
    """
    for p in search.must:
        if p.kind == "TYPE_FILTER" and p.value in (tables or {}):
            rest = replace(search, must=[q for q in search.must if q is not p], key_prefix="")
            return tables[p.value], rest
    if default is None:
        raise ValueError("the search names no known type")
    return default, search


def apply_filter(df: DataFrame, query, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The records of ``df`` a search matches.

    A predicate with a ``values_query`` takes its values from another table:
    key IN (values_field of the records that query matches). It becomes a
    semi-join under must, an anti-join under must_not and a flagged left join
    under should. The value side is made distinct first, so a frequent value
    costs one row; whether it is broadcast is left to Spark's size check.

    Under a nested path some element has to hold one of the values. Records
    are told apart by the set of values their elements hold: each set is
    opened once, and the sets that hold a value are joined back to the records.
    """
    search = as_search(query)
    columns = df.columns
    out, condition_ = _joined(df, search, tables, joins=True)
    return out.where(condition_).select(*[f"`{c}`" for c in columns]) if out.columns != columns else out.where(condition_)


def decided(df: DataFrame, query, tables: Mapping[str, DataFrame] | None = None, name: str = "_matches") -> DataFrame:
    """``df`` with whether each record matches the search; an undecided (null) match is none. See ``apply_filter``."""
    out, condition_ = _joined(df, as_search(query), tables, joins=False)
    return out.select(*[f"`{c}`" for c in df.columns], _surely(condition_).alias(name))


def _joined(df: DataFrame, search: Search, tables: Mapping[str, DataFrame] | None, joins: bool) -> tuple[DataFrame, Column]:
    """``df`` joined with the values that predicates take from other tables, and the condition that is left.

    ``joins``: under must and must_not the joins drop the records themselves; else all are flagged.
    """
    get = table_getter(df)

    def values_of(p: Predicate, name: str) -> DataFrame:
        """The values to be joined with ``joined(p)``; for a nested path, the sets of values that hold one."""
        source, sub = route(as_search(p.values_query), tables, df)
        kept = apply_filter(source, sub, tables)
        value = table_getter(source)(p.values_field)
        values = kept.select(value.alias(name)).where(F.col(name).isNotNull()).distinct()
        if not p.kind.startswith("NESTED"):
            return values
        held = df.select(joined(p).alias("_held")).where(F.size("_held") > 0).distinct()
        opened = held.withColumn("_value", F.explode("_held"))
        return opened.join(values, F.col("_value") == F.col(name), "left_semi").select(F.col("_held").alias(name)).distinct()

    def joined(p: Predicate) -> Column:
        if not p.kind.startswith("NESTED"):
            return get(p.key)
        if not p.path:
            raise ValueError(f"cannot evaluate {p.to_wire()}")
        return F.array_sort(F.array_distinct(F.array_compact(F.transform(get(p.path), lambda e: element_getter(e, p.path)(p.key)))))

    out, flags = df, {}
    for part, how in (("must", "left_semi"), ("must_not", "left_anti"), ("should", "left")):
        for i, p in enumerate(getattr(search, part)):
            if p.values_query is None:
                continue
            name = f"_{part}_{i}"
            dropped = joins and part != "should"
            out = out.join(values_of(p, name), joined(p) == F.col(name), how if dropped else "left")
            flags[id(p)] = F.lit(part == "must") if dropped else F.col(name).isNotNull()

    return out, condition(search, get, lambda p: flags[id(p)] if id(p) in flags else matches(p, get))


# --- short forms --------------------------------------------------------------

def has_type(value):
    return Predicate("TYPE_FILTER", value=value)


def term(key, value):
    return Predicate("TERM_FILTER", key, value)


def terms(key, values):
    return Predicate("TERMS_FILTER", key, list(values))


def between(key, low=None, high=None):
    return Predicate("RANGE_FILTER", key, [low, high])
