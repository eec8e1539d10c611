"""Window results for keys that may hold a large part of all rows.

A plain ``partitionBy(key)`` window puts a whole key into one task. Here one
sample tells which keys are crowded; those are cut into *slabs* of about even
size along their order, the others go through a plain window. A slab is a
function of key and order alone (a row is compared with the sorted bounds of
the sample), so every read of the rows sees the same cut and nothing has to be
stored for it. What other slabs add to a slab comes as one row per slab, or, for
frames of a few rows or a span of values, as the rows next to its border.

``order`` must be total (end it with a unique column) unless said otherwise:
rows equal in every order column cannot be cut apart.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldspan.functions.keys import join_same

# Up to here a sorted head is kept by one task; beyond, only the slabs that the page touches are sorted.
DEEP = 100_000
SLABS = 4_096  # cuts at most; a key that holds a third of 100 TB is cut into pieces of some 25 GB, which a sort spills
SAMPLED = 16  # sampled rows of a slab
LONG_TEXT = 200  # characters of a text that a bound keeps: a bound need not be a value that occurs


class Sort(NamedTuple):
    """One column of an order. Nulls come last in a falling one, and where asked for."""

    column: Column | str
    down: bool = False
    nulls_last: bool = False

    @property
    def value(self) -> Column:
        return F.col(self.column) if isinstance(self.column, str) else self.column

    @property
    def ordering(self) -> Column:
        if self.down:
            return self.value.desc_nulls_last()
        return self.value.asc_nulls_last() if self.nulls_last else self.value.asc_nulls_first()

    def before(self, place: str, bound: str) -> str:
        """SQL: the value at ``place`` comes before the bound."""
        less = f"{place} {'>' if self.down else '<'} {bound}"
        if self.down or self.nulls_last:
            return f"IF({bound} IS NULL, {place} IS NOT NULL, coalesce({less}, FALSE))"
        return f"({bound} IS NOT NULL AND coalesce({less}, TRUE))"


class Cut(NamedTuple):
    """Bounds of slabs: a row's key, 0, 1 or 2 (before, at or behind its rows), and its order."""

    columns: list[Sort]
    by: int  # columns of the key
    bounds: list[tuple]
    types: list[str]


def _sorts(order: Sequence[str | Sort]) -> list[Sort]:
    return [o if isinstance(o, Sort) else Sort(o) for o in order]


def orderings(order: Sequence[str | Sort]) -> list[Column]:
    return [o.ordering for o in _sorts(order)]


def _literal(value, kind: str) -> str:
    if value is None:
        return f"CAST(NULL AS {kind})"
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    if kind == "string":
        return f"CAST(X'{value.encode().hex()}' AS STRING)"
    return f"CAST('{value}' AS {kind})"


def _places(df: DataFrame, columns: list[Sort]) -> DataFrame:
    """``df`` with the values that are compared as ``_here0`` and so on: times by their microseconds, whatever the zone."""
    found = df.withColumns({f"_here{i}": c.value for i, c in enumerate(columns)})
    times = {f"_here{i}": F.unix_micros(f"_here{i}") for i in range(len(columns))
             if isinstance(found.schema[f"_here{i}"].dataType, T.TimestampType)}
    return found.withColumns(times) if times else found


def cut_of(df: DataFrame, by: Sequence[str], order: Sequence[str | Sort], slabs: int | None = None, least_rows: int = 1) -> Cut:
    """Where to cut the crowded keys of ``df``: those with more than two slabs' share of the sampled rows.

    ``least_rows`` keeps a slab from getting smaller than so many rows.
    """
    slabs = min(SLABS, slabs or max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    columns = [*_sorts(by), *_sorts(order)]
    share = min(1.0, SAMPLED * slabs / max(df.count(), 1))
    picked = _places(df, columns).select(*[f"_here{i}" for i in range(len(columns))])
    kinds = [f.dataType.simpleString() for f in picked.schema]
    if share < 1:
        picked = picked.sample(share, 7)
    # SAMPLED * SLABS rows on average at most
    rows = [tuple(r) for r in picked.orderBy(*[c._replace(column=n).ordering for c, n in zip(columns, picked.columns)]).collect()]
    step = max(1, len(rows) // slabs, math.ceil(least_rows * share))
    bounds, at, n = [], 0, len(by)
    while at < len(rows):
        key, end = rows[at][:n], at
        while end < len(rows) and _same(rows[end][:n], key):
            end += 1
        inner = []
        for i in range(at + step, end - step // 2, step):
            if not _same(rows[i], rows[i - 1]):
                inner.append((*key, 1, *(v[:LONG_TEXT] if isinstance(v, str) else v for v in rows[i][n:])))
        if end - at > 2 * step and inner:
            none = (None,) * len(order)
            bounds += [(*key, 0, *none), *inner, (*key, 2, *none)]
        at = end
    return Cut(columns, n, bounds, kinds)


def _same(a: tuple, b: tuple) -> bool:
    return all(x == y or (x != x and y != y) for x, y in zip(a, b))


def with_slab(df: DataFrame, cut: Cut, name: str = "_slab") -> DataFrame:
    """``df`` with the row's slab, 0 for keys that are not cut; the slabs of a key are numbered in a row along its order.

    The bounds are one array, searched by halves: what is planned and compiled does not grow with their number.
    """
    if not cut.bounds:
        return df.withColumn(name, F.lit(0))
    by, many = cut.by, len(cut.bounds)

    def struct(values: list[str], kind: int) -> str:
        named = [f"'c{i}', nullif({v}, NULL)" for i, v in enumerate(values)]  # may be null on both sides: no cast of the struct for each comparison
        return f"named_struct({', '.join([*named[:by], f"'kind', {kind}", *named[by:]])})"

    def literal(bound: tuple) -> str:
        return struct([_literal(v, kind) for v, kind in zip([*bound[:by], *bound[by + 1:]], cut.types)], bound[by])

    here = "get(_bounds, _behind + _step - 1)"

    def then(i: int, rest: str) -> str:
        """SQL: before the bound in this column, or equal there and ``rest``."""
        place, bound = f"_here{i}", f"{here}.c{i}"
        return f"({cut.columns[i].before(place, bound)} OR ({place} <=> {bound} AND {rest}))"

    text = "FALSE"
    for i in range(len(cut.columns) - 1, by - 1, -1):
        text = then(i, text)
    # all rows of the key lie behind its start and before its end
    text = f"({here}.kind = 2 OR {here}.kind = 1 AND {text})"
    for i in range(by - 1, -1, -1):
        text = then(i, text)
    if not any(c.down or c.nulls_last for c in cut.columns):  # the order of structs, in one comparison
        text = f"{here} > {struct([f'_here{i}' for i in range(len(cut.columns))], 1)}"
    steps = ", ".join(str(1 << i) for i in range(many.bit_length() - 1, -1, -1))
    found = f"aggregate(array({steps}), 0, (_behind, _step) -> IF(_behind + _step <= {many} AND NOT {text}, _behind + _step, _behind))"
    # behind bound i lies slab i + 1, unless the bound ends its key
    slabs = ", ".join(["0", *("0" if b[by] == 2 else str(i + 1) for i, b in enumerate(cut.bounds))])
    rows = _places(df, cut.columns).withColumn("_bounds", F.expr(f"array({', '.join(map(literal, cut.bounds))})"))
    return rows.withColumn(name, F.expr(f"get(array({slabs}), {found})")).drop("_bounds", *[f"_here{i}" for i in range(len(cut.columns))])


def by_slabs(df: DataFrame, by: Sequence[str], order: Sequence[str], plain: Callable[[DataFrame], DataFrame],
             cut: Callable[[DataFrame], DataFrame], **limits) -> DataFrame:
    """``plain`` of the keys that one task can hold, and ``cut`` of the crowded ones, which have their ``_slab``."""
    where = cut_of(df, by, order, **limits)
    if not where.bounds:
        return plain(df)
    rows = with_slab(df, where)
    return plain(rows.where("_slab = 0").drop("_slab")).unionByName(cut(rows.where("_slab > 0")).drop("_slab"))


def inside(by: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*by, "_slab").orderBy(*order)


def _rows_of(by: Sequence[str], order: Sequence[str], start: int | None, end: int | None):
    """Rows of the key from ``start`` to ``end``. Spark goes through a frame that ends with the last row anew for each row;
    one that starts with the first row only grows. So the former is the latter in the opposite order."""
    if start is not None and end is None:
        return Window.partitionBy(*by).orderBy(*[F.desc_nulls_last(c) for c in order]).rowsBetween(Window.unboundedPreceding, -start)
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(
        Window.unboundedPreceding if start is None else start, Window.unboundedFollowing if end is None else end)


def earlier(by: Sequence[str]):
    """Of one row per key and slab: the slabs before this one."""
    return Window.partitionBy(*by).orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)


def later(by: Sequence[str]):
    return Window.partitionBy(*by).orderBy("_slab").rowsBetween(1, Window.unboundedFollowing)


def carry(rows: DataFrame, shifts: DataFrame, by: Sequence[str]) -> DataFrame:
    """``rows`` of cut keys with what their key's other slabs add: at most SLABS rows and one for each cut key."""
    return join_same(rows, F.broadcast(shifts), [*by, "_slab"])


def _total(value: str, by: Sequence[str]) -> Column:
    return F.coalesce(F.sum(value).over(earlier(by)), F.lit(0))


def ranked(df: DataFrame, by: Sequence[str], order: Sequence[str], rank_by: Sequence[str]) -> DataFrame:
    """Adds ``row_number`` in ``order``, and ``rank`` and ``dense_rank`` in ``rank_by``, a prefix of it.

    Rows that tie in ``rank_by`` may be cut apart. A slab whose first group goes
    on from the slab before is *joined*: that group counts once, and its rank is
    the place where it began, which may be several slabs back.
    """
    def plain(rows: DataFrame) -> DataFrame:
        placed, tied = Window.partitionBy(*by).orderBy(*order), Window.partitionBy(*by).orderBy(*rank_by)
        return rows.withColumns({"row_number": F.row_number().over(placed).cast("long"), "rank": F.rank().over(tied).cast("long"),
                                 "dense_rank": F.dense_rank().over(tied).cast("long")})

    def cut(rows: DataFrame) -> DataFrame:
        ties = inside(by, rank_by)
        local = rows.withColumns({
            "_row": F.row_number().over(inside(by, order)), "_rank": F.rank().over(ties), "_dense": F.dense_rank().over(ties)})
        group = F.struct(*rank_by)
        # counted from the rows, not from their ranks: the windows above run once
        groups = rows.groupBy(*by, "_slab", *rank_by).agg(F.count(F.lit(1)).alias("_n"))
        edges = groups.groupBy(*by, "_slab").agg(
            F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_groups"), F.max_by("_n", group).alias("_last"),
            F.min(group).alias("_lo"), F.max(group).alias("_hi"))
        slabs = Window.partitionBy(*by).orderBy("_slab")
        upto = slabs.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        edges = edges.withColumns({
            "_shift": _total("_rows", by),
            "_joined": F.coalesce(F.lag("_hi").over(slabs) == F.col("_lo"), F.lit(False))})
        began = F.when(~F.col("_joined") | (F.col("_groups") > 1), F.col("_shift") + F.col("_rows") - F.col("_last") + 1)
        edges = edges.withColumns({
            "_dense_shift": _total("_groups", by) - F.sum(F.col("_joined").cast("long")).over(upto),
            "_began": F.last(began, ignorenulls=True).over(upto)})
        shifts = edges.select(*by, "_slab", "_shift", "_joined", "_dense_shift", F.lag("_began").over(slabs).alias("_began"))
        goes_on = F.col("_joined") & (F.col("_dense") == 1)
        return carry(local, shifts, by).select(
            *rows.columns,
            (F.col("_row") + F.col("_shift")).alias("row_number"),
            F.when(goes_on, F.col("_began")).otherwise(F.col("_rank") + F.col("_shift")).alias("rank"),
            (F.col("_dense") + F.col("_dense_shift")).alias("dense_rank"))

    return by_slabs(df, by, order, plain, cut)


# --- frames ---------------------------------------------------------------------

# A result is worked out of partial results that can be merged: those of a slab and of what other slabs add.
_PARTS = {"sum": ("sum",), "count": ("count",), "min": ("min",), "max": ("max",), "avg": ("sum", "count")}
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def _parts(values: Mapping[str, tuple[str, str]]) -> dict[str, tuple[str, str]]:
    """The partial results that ``values`` need, each once: name to function and column."""
    unknown = {f for f, _ in values.values()} - set(_PARTS)
    if unknown:
        raise ValueError(f"no frames of {sorted(unknown)}; there are {sorted(_PARTS)}")
    needed = dict.fromkeys((part, column) for f, column in values.values() for part in _PARTS[f])
    return {f"_part{i}": key for i, key in enumerate(needed)}


def _partial(kind: str, column: str) -> Column:
    return getattr(F, kind)(column)


def _merged(kind: str, a: Column, b: Column) -> Column:
    if kind in ("min", "max"):
        return (F.least if kind == "min" else F.greatest)(a, b)
    return F.coalesce(a + b, a, b)


def _results(parts: Mapping[str, tuple[str, str]], values: Mapping[str, tuple[str, str]]) -> list[Column]:
    names = {key: name for name, key in parts.items()}
    out = []
    for name, (f, column) in values.items():
        if f == "avg":
            found = F.try_divide(F.col(names["sum", column]), F.col(names["count", column]))
        else:
            found = F.col(names[f, column])
        out.append((F.coalesce(found, F.lit(0)) if f == "count" else found).alias(name))
    return out


def framed(df: DataFrame, by: Sequence[str], order: Sequence[str], values: Mapping[str, tuple[str, str]],
           start: int | None = None, end: int | None = 0) -> DataFrame:
    """Adds, for each name of ``values``, a function (sum, count, avg, min, max) of a column over ROWS BETWEEN ``start``
    AND ``end``: offsets from the row, negative for rows before it, None for no bound.

    Nulls are left out of every function, as in a plain window; a frame without values gives null, and 0 for a count.
    A slab has at least eight times as many rows as a bounded frame reaches, so a frame of most of a key is one task's work.
    """
    if start is not None and end is not None and start > end:
        raise ValueError("a frame starts no later than it ends")
    parts = _parts(values)
    reach = max(0, -(start or 0)) + max(0, end or 0)

    def over(rows: DataFrame, window) -> DataFrame:
        return rows.withColumns({name: _partial(*key).over(window) for name, key in parts.items()})

    def plain(rows: DataFrame) -> DataFrame:
        return over(rows, _rows_of(by, order, start, end)).select(*df.columns, *_results(parts, values))

    def cut(rows: DataFrame) -> DataFrame:
        if start is not None and end is not None:
            found = _near(rows, by, order, start, end, lambda r, w: over(r, w.rowsBetween(start, end)))
        else:
            found = _open(rows, by, order, parts, start, end, over)
        return found.select(*df.columns, "_slab", *_results(parts, values))

    return by_slabs(df, by, order, plain, cut, least_rows=8 * reach)


def _near(rows: DataFrame, by: Sequence[str], order: Sequence[str], start: int, end: int, work) -> DataFrame:
    """``work(rows, window)`` of frames that reach a few rows: each slab for itself, and the rows so close to a border
    that they need some of the next slab once more, from the ends of all slabs of their key."""
    back, ahead = max(0, -start), max(0, end)
    reach = back + ahead
    window = inside(by, order)
    placed = rows.withColumn("_nth", F.row_number().over(window)).withColumn(
        "_after", F.count(F.lit(1)).over(Window.partitionBy(*by, "_slab")) - F.col("_nth"))
    whole = work(placed, window).where((F.col("_nth") > back) & (F.col("_after") >= ahead))
    ends = placed.where((F.col("_nth") <= reach) | (F.col("_after") < reach))
    mended = work(ends, Window.partitionBy(*by).orderBy(*order)).where((F.col("_nth") <= back) | (F.col("_after") < ahead))
    return whole.unionByName(mended).drop("_nth", "_after")


def _open(rows: DataFrame, by: Sequence[str], order: Sequence[str], parts: Mapping, start: int | None, end: int | None, over) -> DataFrame:
    """Frames without a first or a last row: the slab's own part, and what all slabs on the open sides hold. A closed
    side that is not the row itself is added by a short frame behind it, or taken from the row where it ends."""
    side = 0 if start is None and end is None else (end if start is None else start)
    local = over(rows, _rows_of([*by, "_slab"], order, None if start is None else 0, None if end is None else 0))
    totals = rows.groupBy(*by, "_slab").agg(*[_partial(*key).alias(f"_slab{name}") for name, key in parts.items()])
    more = {}
    for name, (kind, _) in parts.items():
        sides = [_MERGE[kind](f"_slab{name}").over(w(by)) for w, is_open in ((earlier, start is None), (later, end is None)) if is_open]
        more[f"_more{name}"] = sides[0] if len(sides) == 1 else _merged(kind, *sides)
    found = carry(local, totals.select(*by, "_slab", *[c.alias(n) for n, c in more.items()]), by)
    found = found.withColumns({n: _merged(kind, F.col(n), F.col(f"_more{n}")) for n, (kind, _) in parts.items()}).drop(*more)
    if side == 0:
        return found
    widens = side > 0 if start is None else side < 0
    if not widens:  # what the frame of the row where this one ends or starts holds
        there = lambda r, w: r.withColumns({n: F.first(n).over(w.rowsBetween(side, side)) for n in parts})
        return _near(found, by, order, side, side, there)
    near = (1, side) if start is None else (side, -1)

    def added(r: DataFrame, w) -> DataFrame:
        frame = w.rowsBetween(*near)
        return r.withColumns({n: _merged(kind, F.col(n), _partial(kind, column).over(frame)) for n, (kind, column) in parts.items()})

    return _near(found, by, order, *near, added)


def running_sum(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Adds the sum of the key's rows up to and with this one."""
    return framed(df, by, order, {name: ("sum", value)})


def framed_by_value(df: DataFrame, by: Sequence[str], at: str, values: Mapping[str, tuple[str, str]],
                    start: float | datetime.timedelta | None = None, end: float | datetime.timedelta | None = 0) -> DataFrame:
    """Adds functions as ``framed`` does, over RANGE BETWEEN ``start`` AND ``end``: the rows of the key whose ``at`` lies
    between the row's own plus ``start`` and plus ``end`` (both included, None for no bound).

    ``at`` is a whole number, a date (offsets in days) or a time (offsets as ``timedelta``); it need not be unique. Rows
    of equal ``at`` share a frame, so they are merged first, and the frames run over distinct values. Rows whose ``at`` is
    null share a frame of their own, and lie in those without a first row, as in a plain window (nulls first).

    No frame is gone through value by value: the line is laid out in blocks as wide as a bounded frame, which then is the
    end of one block and the start of the next. Where the frames end is asked among the values themselves, by rows
    without values of their own; the sums from a block's start, and to its end, are open frames over rows.
    """
    parts = _parts(values)
    kind = df.schema[at].dataType
    if isinstance(kind, T.TimestampType):
        place = F.unix_micros(at)
    elif isinstance(kind, T.TimestampNTZType):
        place = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{at}`)")
    elif isinstance(kind, (T.DateType, T.IntegralType)):
        place = F.unix_date(at) if isinstance(kind, T.DateType) else F.col(at)
    else:
        raise ValueError(f"{at} is neither a whole number nor a time")
    micros = lambda d: d if d is None or not isinstance(d, datetime.timedelta) else d // datetime.timedelta(microseconds=1)
    low, high = micros(start), micros(end)
    if low is not None and high is not None and low > high:
        raise ValueError("a frame starts no later than it ends")
    groups = df.withColumn("_at", place.cast("long")).groupBy(*by, "_at").agg(*[_partial(*key).alias(n) for n, key in parts.items()])
    merge = {n: _MERGE[k] for n, (k, _) in parts.items()}
    running = {f"_run{n}": ("sum" if k == "count" else k, n) for n, (k, _) in parts.items()}
    block = []

    def asked(offset: int, probe: int) -> DataFrame:
        """The sums up to (``probe`` 1) or from (-1) the places that lie ``offset`` behind those of the values."""
        asks = F.lit(True)
        if block and probe > 0:  # a frame that starts with a block is that block
            asks = F.coalesce((F.col("_at") + low) % wide != 0, F.lit(False))
        none = [F.lit(None).cast(groups.schema[n].dataType).alias(n) for n in parts]
        itself = F.struct("_at", F.lit(0).alias("_probe"), F.lit(None).cast("long").alias("_own"), *parts)
        its_probe = F.struct((F.col("_at") + offset).alias("_at"), F.lit(probe).alias("_probe"), F.col("_at").alias("_own"), *none)
        both = groups.select(*by, F.explode(F.when(asks, F.array(itself, its_probe)).otherwise(F.array(itself))).alias("_x")).select(*by, "_x.*")
        if block:  # rounded down
            both = both.withColumn("_block", F.expr(f"_at div {wide}L - int(_at % {wide}L < 0)"))
        found = framed(both, [*by, *block], ["_at", "_probe"], running, None if probe > 0 else 0, 0 if probe > 0 else None)
        return found.where(F.col("_probe") != 0).select(*by, F.col("_own").alias("_at"), *[F.col(f"_run{n}").alias(n) for n in parts])

    if low is None and high is None:
        found = framed(groups, by, ["_at"], running, None, None).select(*by, "_at", *[F.col(f"_run{n}").alias(n) for n in parts])
    elif low is None:
        found = asked(int(high), 1)
    elif high is None:
        found = asked(int(low), -1)
    else:
        wide, block = int(high) - int(low) + 1, ["_block"]
        found = asked(int(low), -1).unionByName(asked(int(high), 1)).groupBy(*by, "_at").agg(*[m(n).alias(n) for n, m in merge.items()])
    keyed = join_same(df.withColumn("_at", place.cast("long")), found, [*by, "_at"])
    return keyed.select(*df.columns, *_results(parts, values))


def neighbours(df: DataFrame, by: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Adds ``previous_c``, ``next_c``, ``first_c`` and ``last_c`` of the key's rows, for each column."""
    entry = F.struct(*order, *[c for c in columns if c not in order])

    def taken(found: dict[str, Column]) -> list[Column]:
        return [e.getField(c).alias(f"{side}_{c}") for side, e in found.items() for c in columns]

    def plain(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order)
        whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        found = rows.withColumn("_entry", entry).withColumns({
            "_previous": F.lag("_entry").over(window), "_next": F.lead("_entry").over(window),
            "_first": F.first("_entry").over(whole), "_last": F.last("_entry").over(whole)})
        return found.select(*df.columns, *taken({side: F.col(f"_{side}") for side in ("previous", "next", "first", "last")}))

    def cut(rows: DataFrame) -> DataFrame:
        window = inside(by, order)
        local = rows.withColumn("_entry", entry).withColumns({
            "_previous": F.lag("_entry").over(window), "_next": F.lead("_entry").over(window)})
        edges = rows.withColumn("_entry", entry).groupBy(*by, "_slab").agg(F.min("_entry").alias("_lo"), F.max("_entry").alias("_hi"))
        slabs, whole = Window.partitionBy(*by).orderBy("_slab"), Window.partitionBy(*by)
        shifts = edges.select(
            *by, "_slab", F.lag("_hi").over(slabs).alias("_from"), F.lead("_lo").over(slabs).alias("_to"),
            F.min("_lo").over(whole).alias("_first"), F.max("_hi").over(whole).alias("_last"))
        found = {"previous": F.coalesce("_previous", "_from"), "next": F.coalesce("_next", "_to"),
                 "first": F.col("_first"), "last": F.col("_last")}
        return carry(local, shifts, by).select(*df.columns, "_slab", *taken(found))

    return by_slabs(df, by, order, plain, cut)


# --- the whole table in one order ----------------------------------------------------

def sequence_numbers(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``_slab`` and the row's place in it as ``_row`` (from 0), and one row per slab.

    The second frame has ``_slab``, ``_shift`` (rows in earlier slabs) and
    ``_total``; the row's number over the whole table is ``_row + _shift``.
    """
    rows = with_slab(df, cut_of(df, [], order))
    sizes = rows.groupBy("_slab").agg(F.count(F.lit(1)).alias("_rows"))
    # at most SLABS rows, so a window over all of them is small
    before = Window.orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_slab").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = Window.partitionBy("_slab").orderBy(*orderings(order))
    return rows.withColumn("_row", F.row_number().over(place).cast("long") - 1), sizes.select(
        "_slab", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"), F.sum("_rows").over(everything).alias("_total"))


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return _orderable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def completed(df: DataFrame, order: Sequence[str | Sort]) -> list[Column]:
    """``order`` made total but for rows that are equal throughout: all other columns follow it, maps and the like as JSON."""
    named = {c.column for c in _sorts(order) if isinstance(c.column, str)}
    rest = [F.col(f"`{f.name}`") if _orderable(f.dataType) else F.to_json(F.struct(f"`{f.name}`"))
            for f in df.schema.fields if f.name not in named]
    return [*orderings(order), *rest]


def first_rows(df: DataFrame, order: Sequence[str | Sort], n: int, offset: int = 0) -> DataFrame:
    """``n`` rows from ``offset`` on in ``order``, completed by all other columns, so that no two pages overlap.

    A short head is Spark's own top-k, which would gather a deep one in a single
    task. For a deep one the table is cut into slabs along the order and these
    are counted: slabs inside the page are taken as they are, and only the one
    or two at its ends are sorted. Both ways give the same rows.
    """
    total = completed(df, order)
    if offset + n <= DEEP:
        return df.orderBy(*total).offset(offset).limit(n)
    rows = with_slab(df, cut_of(df, [], order))
    sizes = sorted(tuple(r) for r in rows.groupBy("_slab").count().collect())  # at most SLABS rows
    inner, ends, before = [], [], 0
    for slab, many in sizes:
        skip, stop = max(0, offset - before), min(many, offset + n - before)
        if skip < stop:
            if stop - skip == many:
                inner.append(slab)
            else:
                ends.append(rows.where(F.col("_slab") == slab).orderBy(*total).offset(skip).limit(stop - skip))
        before += many
    picked = rows.where(F.col("_slab").between(inner[0], inner[-1]) if inner else F.lit(False))
    for end in ends:
        picked = picked.unionByName(end)
    return picked.select(*df.columns).orderBy(*total)
