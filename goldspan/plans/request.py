"""A whole record query: filter, result form, order and size in one call."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame

from goldspan.names import VALUES
from goldspan.operators import controls
from goldspan.operators.windows import Sort, first_rows, orderings
from goldspan.plans.aggregations import run
from goldspan.plans.filters import Search, apply_filter, as_search, record_getter, route
from goldspan.sources.lake import map_batches


def typed_records(tables: Mapping[str, DataFrame], query: Search) -> tuple[DataFrame, Search]:
    """The records of the types a search asks for, and the search left to run on them.

    A required type names one table. Types among the optional predicates, when
    nothing else is optional, name several, whose union by name is searched.
    """
    optional = query.should
    if optional and all(p.kind == "TYPE_FILTER" and p.value in tables for p in optional):
        frames = [tables[p.value] for p in optional]
        both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        return both, Search(query.must, query.must_not, aggregations=query.aggregations)
    return route(query, tables)


def find(
    tables: Mapping[str, DataFrame],
    query: Search | Mapping,
    fields: list[str] | None = None,
    only_hits: bool = True,
    sort_by: str | None = None,
    sort_order: str = "ASC",
    max_hits: float = math.inf,
    offset: int | None = None,
    page_size: int = 100,
    order: list[str] | None = None,
    safe_check: bool = False,
    callback: Callable | None = None,
    callback_schema: str | None = None,
) -> DataFrame:
    """The records a search matches, as one DataFrame instead of pages.

    An ``offset`` asks for one page, ``max_hits`` for the first records; both
    follow ``sort_by`` and then ``order`` (default: the record id), so that the
    same question has the same answer.
    """
    rows, search = typed_records(tables, as_search(query))
    rows = apply_filter(rows, search, tables)
    if safe_check:
        controls.check_unique(rows)
    ties = order or ["mdmId"]
    if sort_by or offset is not None or max_hits != math.inf:
        field = [record_getter(rows.columns)(sort_by)] if sort_by else []
        total = [*[Sort(f, sort_order.upper() == "DESC", nulls_last=True) for f in field], *ties]
        if offset is not None:
            rows = first_rows(rows, total, int(min(page_size, max_hits)), offset)
        elif max_hits != math.inf:
            rows = first_rows(rows, total, int(max_hits))
        else:
            rows = rows.orderBy(*orderings(total))
    if fields:
        rows = controls.pick_fields(rows, fields)
    elif only_hits and VALUES in rows.columns:
        rows = controls.hits_only(rows)
    if callback:
        rows = map_batches(rows, callback, callback_schema or rows.schema)
    return rows


def aggregations(tables: Mapping[str, DataFrame], query: Search | Mapping) -> dict[str, DataFrame]:
    """The aggregation frames of a search over the types it asks for."""
    rows, search = typed_records(tables, as_search(query))
    return run(rows, search, tables)
