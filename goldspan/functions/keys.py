"""Joins on keys that may be null."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_same(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of both sides in which null is a value like any other.

    The key columns of the left side are kept. Spark still hashes and sorts on
    null-safe equality.
    """
    names = {c: f"_same_{c}" for c in on}
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    return left.join(right.withColumnsRenamed(names), same, how).drop(*names.values())
