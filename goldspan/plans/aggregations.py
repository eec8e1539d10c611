"""The aggregation language: JSON or Python form to groupBy plans.

An aggregation is a *metric* (one value or a fixed set of values), a *bucket*
(one row per key) or a *scope* (FILTER narrows the records, NESTED moves to the
elements of an array, also of one inside another). Sub-aggregations that are metrics become extra columns
of the same groupBy. Buckets in buckets are counted once at the finest level,
the levels above are merged from that; each level is limited to the buckets its
parent kept. What cannot be merged (ranges, scopes, distinct counts, variances)
is a groupBy of its own.

Rules: records with a null key form no bucket. ``size`` limits TERM and TERMS
(0 keeps all), ranked by count and then key unless ``sort_by`` says otherwise;
inside a parent it limits per parent. HISTOGRAM and DATE_HISTOGRAM fill the
empty buckets between the first and the last when ``min_doc_count`` is 0.
RANGE includes its lower and excludes its upper end; ranges may overlap.
``shard_size`` is accepted and has no effect: results are exact anyway.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DataType, DateType, DecimalType, NumericType, StringType,
                               TimestampNTZType, TimestampType)

from goldspan.functions.keys import join_same
from goldspan.names import VALUES
from goldspan.operators.windows import Sort, first_rows, orderings
from goldspan.plans.filters import apply_filter, as_search, record_getter
from goldspan.session import stored

METRICS = {
    "MINIMUM", "MAXIMUM", "AVERAGE", "COUNT", "SUM", "STATS", "EXTENDED_STATS", "CARDINALITY",
}
BUCKETS = {"TERM", "TERMS", "HISTOGRAM", "DATE_HISTOGRAM", "RANGE"}
SCOPES = {"FILTER", "NESTED"}

# JSON names of the attributes.
_WIRE = {
    "kind": "type", "name": "name", "params": "params", "size": "size",
    "shard_size": "shardSize", "min_doc_count": "minDocCount",
    "sort_by": "sortBy", "sort_order": "sortOrder",
}

_MONTHS = {"year": 12, "quarter": 3, "month": 1}
_STEP_SECONDS = {"week": 604_800, "day": 86_400, "hour": 3_600, "minute": 60, "second": 1}
_CALENDAR = {"1y": "year", "1q": "quarter", "1M": "month", "1w": "week", "1d": "day", "1h": "hour", "1m": "minute", "1s": "second"}
_SECONDS = {"s": 1, "m": 60, "h": 3_600, "d": 86_400}
_MARK = "_by_"
_BLOCK = 4096  # grid buckets made per exploded row
_SALTS = 32
CLOSE = 0.02  # relative standard deviation of an approximate distinct count: a tenth is five of them


@dataclass(frozen=True)
class Aggregation:
    kind: str
    name: str
    params: Any = None
    sub: tuple = ()
    size: int = 10
    shard_size: int = 10
    min_doc_count: int = 0
    sort_by: str | None = None
    sort_order: str | None = None
    query: Any = None

    def __post_init__(self):
        if self.kind not in METRICS | BUCKETS | SCOPES:
            raise ValueError(f"unknown aggregation {self.kind}")
        if not isinstance(self.sub, (list, tuple)):
            raise ValueError("sub-aggregations must be a list")

    def to_wire(self) -> dict:
        wire = {w: getattr(self, name) for name, w in _WIRE.items() if getattr(self, name) is not None}
        if self.sub:
            wire["subAggregations"] = [a.to_wire() for a in self.sub]
        if self.query is not None:
            wire["queryParam"] = as_search(self.query).to_wire()
        return wire

    @classmethod
    def from_wire(cls, wire: Mapping) -> Aggregation:
        given = {name: wire[w] for name, w in _WIRE.items() if w in wire}
        given.setdefault("size", 0)  # a request that names no size asks for all buckets
        if "queryParam" in wire:
            given["query"] = as_search(wire["queryParam"])
        return cls(sub=tuple(cls.from_wire(a) for a in wire.get("subAggregations", [])), **given)

    @property
    def field(self) -> str:
        return self.params["field"] if isinstance(self.params, Mapping) else self.params

    def option(self, name: str, default=None):
        return self.params.get(name, default) if isinstance(self.params, Mapping) else default


def _extreme(find: Callable[[Column], Column], value: Column, kind: DataType) -> Column:
    """The least or greatest value of a group.

    Spark's hash aggregates change values of fixed width only: for a text it would sort all
    records first. Beside an aggregate that keeps objects (here an empty set) it hashes them.
    """
    if not isinstance(kind, StringType | BinaryType):
        return find(value)
    return F.coalesce(find(value), F.get(F.collect_set(F.lit(None).cast(kind)), F.lit(0)))


def _metric_columns(agg: Aggregation, value: Column, kind: DataType) -> list[Column]:
    n = agg.name
    if agg.kind == "CARDINALITY":
        exact = agg.option("exact", False)
        return [(F.count_distinct(value) if exact else F.approx_count_distinct(value, CLOSE)).alias(n)]
    least, greatest = (partial(_extreme, find, kind=kind) for find in (F.min, F.max))
    single = {"MINIMUM": least, "MAXIMUM": greatest, "AVERAGE": F.avg, "COUNT": F.count, "SUM": F.sum}
    if agg.kind in single:
        return [single[agg.kind](value).alias(n)]
    columns = [
        F.count(value).alias(f"{n}_count"), least(value).alias(f"{n}_min"),
        greatest(value).alias(f"{n}_max"), F.avg(value).alias(f"{n}_avg"),
        F.sum(value).alias(f"{n}_sum"),
    ]
    if agg.kind == "EXTENDED_STATS":
        spread = F.stddev_pop(value)
        columns += [
            F.sum(value * value).alias(f"{n}_sum_of_squares"),
            F.var_pop(value).alias(f"{n}_variance"),
            spread.alias(f"{n}_std_deviation"),
            (F.avg(value) + 2 * spread).alias(f"{n}_upper"),
            (F.avg(value) - 2 * spread).alias(f"{n}_lower"),
        ]
    return columns


def _metrics(aggs, rows: DataFrame) -> list[Column]:
    get = record_getter(rows.columns)
    asked = [a for a in aggs if a.kind in METRICS]
    kinds = [f.dataType for f in rows.select(*[get(a.field).alias(f"_{i}") for i, a in enumerate(asked)]).schema]
    return [c for a, kind in zip(asked, kinds) for c in _metric_columns(a, get(a.field), kind)]


def _key_columns(rows: DataFrame, agg: Aggregation) -> tuple[dict[str, Column], list[str]]:
    """The bucket key columns of a record, null where it is in no bucket, and their names.

    Keys carry a mark until the end, so that a bucket may be called like a
    field that a sub-aggregation reads.
    """
    get = record_getter(rows.columns)
    n = _MARK + agg.name
    if agg.kind == "TERM":
        return {n: get(agg.field)}, [n]
    if agg.kind == "TERMS":
        fields = agg.params["field"] if isinstance(agg.params, Mapping) else agg.params
        names = {f"{n}_{f.removesuffix('.raw').split('.')[-1]}": get(f) for f in fields}
        return names, list(names)
    if agg.kind == "HISTOGRAM":
        width = agg.params["interval"]
        return {n: F.floor(get(agg.field).cast("double") / width).cast("double") * width}, [n]
    step = _interval(agg)
    key = F.date_trunc(step, get(agg.field)) if isinstance(step, str) else F.timestamp_seconds(
        F.floor(F.unix_seconds(get(agg.field).cast("timestamp")) / step) * step)
    return {n: key.cast("timestamp_ntz")}, [n]


def _keyed(rows: DataFrame, agg: Aggregation) -> tuple[DataFrame, list[str]]:
    """``rows`` with the bucket key columns added, and their names."""
    if agg.kind != "RANGE":
        columns, names = _key_columns(rows, agg)
        return rows.withColumns(columns).dropna(subset=names), names
    # a record is repeated once per range that holds it
    value = record_getter(rows.columns)(agg.field)
    members = [F.when(_in_range(value, low, high, _range_type(agg)), end) for (low, high), end in zip(_ranges(agg), _range_ends(agg))]
    spread = rows.withColumn("_range", F.explode(F.array_compact(F.array(*members))))
    return spread.withColumns({f: F.col("_range").getField(f) for f in _range_names(agg)}).drop("_range"), _range_names(agg)


def _interval(agg: Aggregation) -> str | int:
    """A date histogram's step: a calendar unit, or seconds from 1970 on (``6h``, ``30m``, ``7d``)."""
    given = str(agg.params["interval"])
    unit = _CALENDAR.get(given, given.lower())
    if unit in _MONTHS or unit in _STEP_SECONDS:
        return unit
    fixed = re.fullmatch(r"([1-9][0-9]*)([smhd])", given)
    if fixed is None:
        raise ValueError(f"no interval of a date histogram: {given!r}")
    return int(fixed[1]) * _SECONDS[fixed[2]]


def _is_number(end) -> bool:
    try:
        float(end)
    except (TypeError, ValueError):
        return False
    return True


def _range_type(agg: Aggregation) -> str:
    """Numbers are compared as such, any other ends as times."""
    return "double" if all(_is_number(end) for pair in _ranges(agg) for end in pair if end is not None) else "timestamp_ntz"


def _ranges(agg: Aggregation) -> list[tuple]:
    """The listed (from, to) pairs, each once."""
    return list(dict.fromkeys((low, high) for low, high in agg.params["ranges"]))


def _range_names(agg: Aggregation) -> list[str]:
    return [f"{_MARK}{agg.name}_from", f"{_MARK}{agg.name}_to"]


def _range_ends(agg: Aggregation) -> list[Column]:
    """The listed ranges as structs of their two ends."""
    low, high = _range_names(agg)
    kind = _range_type(agg)
    return [F.struct(F.lit(lo).cast(kind).alias(low), F.lit(hi).cast(kind).alias(high)) for lo, hi in _ranges(agg)]


def _in_range(value: Column, low, high, kind: str) -> Column:
    test = value.isNotNull()
    if low is not None:
        test = test & (value >= (F.lit(low) if kind == "double" else F.lit(low).cast(kind)))
    if high is not None:
        test = test & (value < (F.lit(high) if kind == "double" else F.lit(high).cast(kind)))
    return test


def _order(agg: Aggregation, keys: list[str]) -> list[Sort]:
    by = (agg.sort_by or "").lstrip("_")
    down = (agg.sort_order or "").upper() == "DESC"
    if by in ("key", "term"):
        return [Sort(k, down) for k in keys]
    if by == "":
        by, down = "count", True
    return [Sort("doc_count" if by == "count" else by, down, nulls_last=True), *map(Sort, keys)]


def _range_frame(counted: DataFrame, agg: Aggregation, parents: list[str], rows: DataFrame) -> DataFrame:
    """Every listed range with its count, 0 where no record lies in it; under a parent, for each of its buckets."""
    above = rows.select(*parents).distinct() if parents else counted.sparkSession.range(1)
    listed = above.select(*parents, F.inline(F.array(*_range_ends(agg))))
    return join_same(listed, counted, [*parents, *_range_names(agg)], "left").fillna(0, subset=["doc_count"])


def _grid(frame: DataFrame, agg: Aggregation, parents: list[str]) -> DataFrame:
    """Every bucket between the first and the last one, per parent.

    Made in two explodes, blocks of steps and then the steps of a block, so a
    fine grid over a wide span never sits in one array; the blocks are dealt out
    in between, so that no task makes the grid of a whole span alone.
    """
    n = _MARK + agg.name
    # whole rows are compared, not bare keys: a frame read in full here and in
    # the join is one exchange to Spark, worked out once
    row = F.struct(n, *[c for c in frame.columns if c not in (n, *parents)])
    edges = frame.groupBy(*parents).agg(F.min(row).getField(n).alias("_lo"), F.max(row).getField(n).alias("_hi"))
    edges = edges.where(F.col("_lo").isNotNull())
    step = None if agg.kind == "HISTOGRAM" else _interval(agg)
    if step is None:
        width = agg.params["interval"]
        first, last = (F.round(F.col(c) / width).cast("long") for c in ("_lo", "_hi"))
        key = F.col("_i").cast("double") * width
    elif step in _MONTHS:
        first, last = F.lit(0).cast("long"), F.floor(F.round(F.months_between("_hi", "_lo")) / _MONTHS[step])
        key = F.col("_lo") + F.make_ym_interval(F.lit(0), (F.col("_i") * _MONTHS[step]).cast("int"))
    else:
        seconds = step if isinstance(step, int) else _STEP_SECONDS[step]
        apart = F.timestamp_diff("SECOND", F.col("_lo"), F.col("_hi"))
        first, last = F.lit(0).cast("long"), F.floor(apart / seconds)
        key = F.col("_lo") + F.make_dt_interval(F.floor(F.col("_i") * seconds / 86_400).cast("int"), F.lit(0), F.lit(0), F.pmod(F.col("_i") * seconds, F.lit(86_400)).cast("decimal(18,6)"))
    blocks = edges.select(*parents, "_lo", last.alias("_last"), F.explode(F.sequence(first, last, F.lit(_BLOCK).cast("long"))).alias("_start"))
    stop = F.least(F.col("_start") + (_BLOCK - 1), F.col("_last"))
    dealt = blocks.repartition(*parents, "_start")
    return dealt.select(*parents, "_lo", F.explode(F.sequence("_start", stop)).alias("_i")).select(*parents, key.alias(n))


def _shaped(counted: DataFrame, agg: Aggregation, parents: list[str], keys: list[str], rows: DataFrame) -> DataFrame:
    """Empty buckets, the minimum count, the order and the size of one level; ``rows``: what its buckets are made of."""
    if agg.kind == "RANGE":
        if agg.min_doc_count == 0:
            return _range_frame(counted, agg, parents, rows)
        return counted.where(F.col("doc_count") >= agg.min_doc_count)
    if agg.kind in ("HISTOGRAM", "DATE_HISTOGRAM"):
        if agg.min_doc_count == 0:
            on = [*parents, *keys]
            counted = join_same(_grid(counted, agg, parents), counted, on, "left").fillna(0, subset=["doc_count"])
        else:
            counted = counted.where(F.col("doc_count") >= agg.min_doc_count)
        return counted.orderBy(*parents, *(orderings(_order(agg, keys)) if agg.sort_by else keys))
    if agg.min_doc_count > 1:
        counted = counted.where(F.col("doc_count") >= agg.min_doc_count)
    order = _order(agg, keys)
    if not parents:
        return first_rows(counted, order, agg.size) if agg.size else counted.orderBy(*orderings(order))
    if agg.size:
        # a parent may have very many buckets: the first of each salt, then the first of those
        for keys_of in ([*parents, F.pmod(F.xxhash64(*keys), F.lit(_SALTS))], parents):
            rank = F.row_number().over(Window.partitionBy(*keys_of).orderBy(*orderings(order)))
            counted = counted.withColumn("_rank", rank).where(F.col("_rank") <= agg.size).drop("_rank")
    return counted.orderBy(*parents, *orderings(order))


def _elements(rows: DataFrame, path: str) -> DataFrame:
    """A row for each element of the array at ``path``; arrays on the way are opened too, one generator each.

    An element takes the place of its array, so its fields go by their full
    paths, and the fields of the record and of the elements above stay in reach.
    The last part of the path names the element as well, where no column does.
    """
    parts = path.split(".")
    if parts[0] == VALUES and VALUES not in rows.columns:
        parts = parts[1:]  # a flat table
    for depth in range(1, len(parts) + 1):
        here = F.col(".".join(f"`{p}`" for p in parts[:depth]))
        if not isinstance(rows.select(here).schema[0].dataType, ArrayType):
            continue
        opened = rows.withColumn("_element", F.explode(here))
        if depth == 1:
            rows = opened.withColumn(parts[0], F.col("_element"))
        else:
            rows = opened.withColumn(parts[0], F.col(f"`{parts[0]}`").withField(".".join(f"`{p}`" for p in parts[1:depth]), F.col("_element")))
        rows = rows.drop("_element")
    if len(parts) > 1 and parts[-1] not in rows.columns:
        rows = rows.withColumn(parts[-1], F.col(".".join(f"`{p}`" for p in parts)))
    return rows


def _scoped(rows: DataFrame, agg: Aggregation, tables) -> DataFrame:
    return apply_filter(rows, agg.query, tables) if agg.kind == "FILTER" else _elements(rows, agg.field)


# --- buckets in buckets -----------------------------------------------------------

# A metric that can be worked out of partial results of finer buckets.
_PARTS = {"MINIMUM": ("min",), "MAXIMUM": ("max",), "COUNT": ("count",), "SUM": ("sum",), "AVERAGE": ("sum", "count"),
          "STATS": ("count", "min", "max", "sum")}
_KEYED_ONCE = {"TERM", "TERMS", "HISTOGRAM", "DATE_HISTOGRAM"}  # a record is in one bucket at most


def _part(part: str, value: Column, kind: DataType) -> Column:
    return _extreme(getattr(F, part), value, kind) if part in ("min", "max") else getattr(F, part)(value)


def _mergeable(agg: Aggregation, rows: DataFrame) -> bool:
    if agg.kind not in _KEYED_ONCE:
        return False
    get = record_getter(rows.columns)
    plain = (NumericType, StringType, DateType, TimestampType, TimestampNTZType, BooleanType)
    for m in agg.sub:
        if m.kind in METRICS:
            kind = rows.select(get(m.field)).schema[0].dataType if m.kind in _PARTS else None
            # the mean of decimals has a type of its own
            if not isinstance(kind, plain) or isinstance(kind, DecimalType) and m.kind in ("AVERAGE", "STATS"):
                return False
    return True


def _chain(agg: Aggregation, rows: DataFrame) -> list[Aggregation]:
    """The bucket and its first sub-bucket, and so on, as far as their results can be merged."""
    found = []
    while agg is not None and _mergeable(agg, rows):
        found.append(agg)
        agg = next((s for s in agg.sub if s.kind not in METRICS), None)
    return found


class _Partials:
    """The levels of a chain of buckets, counted in one pass over the records at the finest level, and stored.

    Coarser levels are merged from that: a record without a key of a finer
    level still counts on the levels above.
    """

    def __init__(self, rows: DataFrame, chain: list[Aggregation], parents: list[str]):
        get = record_getter(rows.columns)
        wanted = dict.fromkeys((part, m.field) for a in chain for m in a.sub if m.kind in METRICS for part in _PARTS[m.kind])
        self.names = {key: f"_part{i}" for i, key in enumerate(wanted)}
        values = {f"_value{i}": get(field) for i, field in enumerate(dict.fromkeys(f for _, f in wanted))}
        value_of = dict(zip(dict.fromkeys(f for _, f in wanted), values))
        keyed, self.keys = rows.withColumns(values) if values else rows, []
        for a in chain:
            columns, keys = _key_columns(keyed, a)
            keyed = keyed.withColumns(columns)
            self.keys.append(keys)
        kinds = {f.name: f.dataType for f in keyed.schema}
        parts = [_part(part, F.col(value_of[field]), kinds[value_of[field]]).alias(name) for (part, field), name in self.names.items()]
        keyed = keyed.dropna(subset=self.keys[0])
        finest = keyed.groupBy(*parents, *[k for keys in self.keys for k in keys]).agg(F.count(F.lit(1)).alias("_count"), *parts)
        self.frame = stored(finest, "buckets")

    def level(self, depth: int, agg: Aggregation, parents: list[str], kept: DataFrame | None) -> DataFrame:
        """Counts and metrics of the level; ``kept``: the buckets of the nearest limited level above that are left."""
        keys = self.keys[depth]
        rows = self.frame.dropna(subset=keys)
        if kept is not None:
            rows = join_same(rows, kept, kept.columns, "left_semi")
        kinds = {f.name: f.dataType for f in rows.schema}
        merged = [_part("sum" if part == "count" else part, F.col(name), kinds[name]).alias(name) for (part, _), name in self.names.items()]
        found = rows.groupBy(*parents, *keys).agg(F.sum("_count").alias("doc_count"), *merged)
        return found.select(*parents, *keys, "doc_count", *[c for m in agg.sub if m.kind in METRICS for c in self._metric(m)])

    def _metric(self, m: Aggregation) -> list[Column]:
        part = lambda kind: F.col(self.names[kind, m.field])
        mean = lambda: F.try_divide(part("sum").cast("double"), part("count"))
        if m.kind == "AVERAGE":
            return [mean().alias(m.name)]
        if m.kind == "STATS":
            return [c.alias(f"{m.name}_{n}") for n, c in (("count", part("count")), ("min", part("min")), ("max", part("max")), ("avg", mean()), ("sum", part("sum")))]
        return [part(_PARTS[m.kind][0]).alias(m.name)]


def _level(rows: DataFrame, agg: Aggregation, parents: list[str], path: str, out: dict, tables,
           partials: _Partials | None = None, depth: int = 0, above: DataFrame | None = None) -> None:
    """Fills ``out`` with the frame of ``agg`` and those below it.

    ``rows``: the records in the buckets of the levels above; ``partials``: the
    one pass over them, if this level is part of a chain that has begun.
    """
    if agg.kind in METRICS:
        out[path] = rows.groupBy(*parents).agg(*_metrics([agg], rows))
        return
    source = rows
    chain = _chain(agg, rows) if partials is None else []
    if len(chain) > 1:
        partials, depth, above = _Partials(rows, chain, parents), 0, None
    if agg.kind in SCOPES:
        rows, keys = _scoped(rows, agg, tables), []
    else:
        rows, keys = _keyed(rows, agg)
    on = [*parents, *keys]
    if partials is not None:
        frame = partials.level(depth, agg, parents, above)
    else:
        frame = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("doc_count"), *_metrics(agg.sub, rows))
    if agg.kind not in SCOPES:
        frame = _shaped(frame, agg, parents, keys, source)
    out[path] = frame.withColumnsRenamed({k: k.removeprefix(_MARK) for k in on})
    limited = agg.kind in ("TERM", "TERMS") and agg.size
    below = [s for s in agg.sub if s.kind not in METRICS]
    for sub in below:
        # at most size buckets (per parent): Spark sees the size and decides how to join
        kept = join_same(rows, frame.select(*on), on, "left_semi") if limited else rows
        goes_on = partials is not None and sub is below[0] and depth + 1 < len(partials.keys)
        _level(kept, sub, on, f"{path}.{sub.name}", out, tables, partials if goes_on else None, depth + 1, frame.select(*on) if limited else above)


def aggregate(df: DataFrame, agg: Aggregation | Mapping,
              tables: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """One frame per bucket level, keyed by dotted aggregation names.

    A frame holds the keys of its ancestors, its own key, ``doc_count`` and one
    column per metric below it. ``tables`` serve value queries in filters.
    """
    if isinstance(agg, Mapping):
        agg = Aggregation.from_wire(agg)
    out: dict[str, DataFrame] = {}
    _level(df, agg, [], agg.name, out, tables)
    return out


def metrics(df: DataFrame, aggs: list[Aggregation]) -> DataFrame:
    """All the given metrics in one pass: a single row."""
    return df.agg(*_metrics(aggs, df))


def run(df: DataFrame, query, tables: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Filter, then every aggregation of a search. Plain metrics share the frame ``metrics``."""
    search = as_search(query)
    rows = apply_filter(df, search, tables)
    out: dict[str, DataFrame] = {}
    plain = [a for a in search.aggregations if a.kind in METRICS]
    if plain:
        out["metrics"] = metrics(rows, plain)
    for agg in search.aggregations:
        if agg.kind not in METRICS:
            out.update(aggregate(rows, agg, tables))
    return out


def nested_buckets(parent: DataFrame, child: DataFrame, keys: list[str], name: str, order: Sequence[str | Sort] = ()) -> DataFrame:
    """Child buckets folded into their parent row as an array of structs, in ``order``, then by their columns.

    ``bucket_order`` gives the order in which an aggregation ranks its buckets.
    Both sides are limited frames (``size`` rows per level), so the array is.
    """
    inner = [c for c in child.columns if c not in keys]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*orderings(order), *inner))
    placed = child.withColumn("_place", place)
    folded = placed.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_place", *inner))).alias("_found"))
    bare = F.transform("_found", lambda b: F.struct(*[b[c].alias(c) for c in inner]))
    return join_same(parent, folded.select(*keys, bare.alias(name)), keys, "left")


def bucket_order(agg: Aggregation) -> list[Sort]:
    """The order of an aggregation's buckets, by the columns of its frame."""
    if agg.kind in ("TERM", "TERMS"):
        fields = agg.params["field"] if agg.kind == "TERMS" and isinstance(agg.params, Mapping) else agg.params
        keys = [agg.name] if agg.kind == "TERM" else [f"{agg.name}_{f.removesuffix('.raw').split('.')[-1]}" for f in fields]
        return _order(agg, keys)
    return _order(agg, [agg.name]) if agg.sort_by and agg.kind != "RANGE" else []
