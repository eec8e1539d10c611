"""Sending records: declared staging tables, and batches that show as a whole or not at all.

A batch writes its records below ``batches/source=…/batch=…`` of the lake; scans of
staging tables add the rows of those batches that ``manifests`` names. The manifest
is one small file, written last, so a send that dies earlier leaves nothing visible,
and the same batch can be sent again.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldspan.operators.master import check_crosswalk_unique
from goldspan.operators.rules import Rule, errors_of
from goldspan.operators.schema import check_crosswalk, enforce, infer_from_sample
from goldspan.operators.windows import sequence_numbers
from goldspan.session import path_exists, stored
from goldspan.sources.lake import MANIFEST, Lake, source_name


class Declaration(NamedTuple):
    """A staging table as declared: ``fields`` maps names to Spark types; ``flexible`` tables take other fields too."""

    version: int
    crosswalk: list[str]
    fields: dict[str, str]
    flexible: bool


_STORED = "crosswalk array<string>, fields array<struct<name: string, type: string>>, flexible boolean, version int"


class Declarations:
    """The versions of all declared staging tables of a lake; the latest one counts."""

    def __init__(self, lake: Lake):
        self.lake = lake

    def _folder(self, connector: str, staging: str) -> str:
        return f"{self.lake.root}/declarations/source={source_name(connector, staging)}"

    def get(self, connector: str, staging: str, version: int | None = None) -> Declaration | None:
        """The latest version, or the given one; None if there is none."""
        folder = self._folder(connector, staging)
        if not path_exists(self.lake.spark, folder):
            return None
        found = self.lake.spark.read.schema(_STORED).json(folder)
        if version is not None:
            found = found.where(F.col("version") == version)
        row = found.orderBy(F.desc("version")).first()
        return row and Declaration(row["version"], row["crosswalk"], {f["name"]: f["type"] for f in row["fields"]}, row["flexible"])

    def create(self, data: DataFrame | Mapping[str, Any], connector: str, staging: str, crosswalk: Sequence[str],
               flexible: bool = False, overwrite: bool = False) -> Declaration:
        """Declares a table after a frame's schema or a sample record.

        With ``overwrite`` a declared table gets a new version, which keeps the
        fields that ``data`` lacks if it is flexible; without it that is an error.
        """
        last = self.get(connector, staging)
        if last and not overwrite:
            raise ValueError(f"{source_name(connector, staging)} is declared already")
        schema = data.schema if isinstance(data, DataFrame) else infer_from_sample(data)
        fields = {f.name: f.dataType.simpleString() for f in schema}
        check_crosswalk(list(fields), list(crosswalk))
        if last and flexible:
            fields = {**last.fields, **fields}
        return self._store(connector, staging, Declaration(last.version + 1 if last else 1, list(crosswalk), fields, flexible))

    def _store(self, connector: str, staging: str, declared: Declaration) -> Declaration:
        row = [(declared.crosswalk, list(declared.fields.items()), declared.flexible)]
        frame = self.lake.spark.createDataFrame(row, _STORED.removesuffix(", version int")).coalesce(1)
        for version in range(declared.version, declared.version + 100):
            try:  # a version that another sender wrote meanwhile, or left unfinished, is not touched
                frame.write.mode("errorifexists").json(f"{self._folder(connector, staging)}/version={version}")
            except AnalysisException as error:
                if error.getCondition() != "PATH_ALREADY_EXISTS":
                    raise
            else:
                return declared._replace(version=version)
        raise RuntimeError(f"no free version of {source_name(connector, staging)}")


class Batch:
    """One batch: any number of sends, whose requests are numbered on, and then ``end``, which makes them visible."""

    def __init__(self, lake: Lake, batch_id: str):
        if not batch_id or "/" in batch_id:
            raise ValueError("a batch needs an id without slashes")
        self.lake, self.batch_id, self.ended = lake, batch_id, False
        self.records = self.requests = self.parts = 0
        # what an attempt that died has written stays invisible: its folder is not this one
        self.folder = f"_{batch_id}.{uuid.uuid4().hex[:8]}"
        self.sources: list[str] = []
        self.started = datetime.datetime.now(datetime.timezone.utc)

    @property
    def _manifest(self) -> str:
        return f"{self.lake.root}/manifests/batch=_{self.batch_id}"

    def send(self, df: DataFrame, connector: str, staging: str, ingest_date: str, crosswalk: Sequence[str] | None = None,
             types: Mapping[str, str] | None = None, rules: Sequence[Rule] = (), step_size: int = 500, force: bool = False,
             auto_create_schema: bool = False, crosswalk_auto_create: Sequence[str] | None = None,
             flexible_schema: bool = False) -> None:
        """Types, rules and slices of ``step_size`` records for one staging table; nothing is visible yet.

        A declared table gives the crosswalk and the types that are not named
        here, and refuses fields it does not know unless it is flexible; those
        are then declared. ``auto_create_schema`` declares the table first (a
        new version, if it is there), with the crosswalk ``crosswalk_auto_create``.
        Bad values and records that a rule rejects go to the rejected space with
        their errors. The crosswalk must be unique within the send, and orders the
        slices; with ``force`` it may repeat, and the other columns settle the order.

        ``df`` is computed once: everything else reads what that left.
        """
        if self.ended:
            raise ValueError(f"batch {self.batch_id} has ended")
        if step_size < 1:
            raise ValueError("step_size is at least 1")
        tables = Declarations(self.lake)
        if auto_create_schema:
            if crosswalk_auto_create is None:
                raise ValueError("a table is declared with a crosswalk: give crosswalk_auto_create")
            check_crosswalk(df.columns, list(crosswalk_auto_create))
            declared = tables.create(df, connector, staging, crosswalk_auto_create, flexible_schema, overwrite=True)
        else:
            declared = tables.get(connector, staging)
        if declared:
            crosswalk = list(crosswalk or declared.crosswalk)
            unknown = [c for c in df.columns if c not in declared.fields]
            if unknown and not declared.flexible:
                raise ValueError(f"{source_name(connector, staging)} does not know {unknown}")
            if unknown:
                kinds = {f.name: f.dataType.simpleString() for f in df.schema}
                tables._store(connector, staging, declared._replace(
                    version=declared.version + 1, fields={**declared.fields, **{c: kinds[c] for c in unknown}}))
        elif crosswalk is None:
            raise ValueError(f"{source_name(connector, staging)} is not declared: give its crosswalk")
        check_crosswalk(df.columns, list(crosswalk))
        typed = _as_declared(df, declared.fields if declared else {}, dict(types or {}))
        checked = stored(errors_of(typed, rules), "send")
        check_crosswalk_unique(checked, crosswalk, force)
        rest = [c for c in df.columns if c not in crosswalk]
        rows, shifts = sequence_numbers(checked, [*crosswalk, *rest] if force else list(crosswalk))
        # one row per slab: windows.SLABS bounds its size
        number = F.floor((F.col("_row") + F.col("_shift")) / step_size).cast("long") + 1 + self.requests
        sliced = rows.join(F.broadcast(shifts), "_slab").withColumns({
            "sequence": number, "batch_id": F.lit(self.batch_id), "ingest_date": F.to_date(ingest_date),
            "space": F.when(F.size("mdmErrors") > 0, "staging_rejected").otherwise("staging")})
        source = source_name(connector, staging)
        path = f"{self.lake.root}/batches/source={source}/batch={self.folder}/part={self.parts}"
        sliced.select(*checked.columns, "sequence", "batch_id", *[c for c in ("ingest_date",) if c not in checked.columns], "space") \
            .hint("rebalance", "space", "ingest_date").write.partitionBy("space", "ingest_date").parquet(path)
        many = checked.count()
        self.records, self.requests, self.parts = self.records + many, self.requests - (-many // step_size), self.parts + 1
        self.sources = list(dict.fromkeys([*self.sources, source]))

    def end(self) -> DataFrame:
        """Makes the batch visible and returns its account: ``batch_id``, ``total_records``, ``total_requests``."""
        if self.ended:
            raise ValueError(f"batch {self.batch_id} has ended")
        row = (self.folder, self.batch_id, self.sources, self.records, self.requests, self.started.isoformat(),
               datetime.datetime.now(datetime.timezone.utc).isoformat())
        # one file: it is there as a whole or not at all; a batch of this id that has ended is not replaced
        self.lake.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("errorifexists").json(self._manifest)
        self.ended = True
        return account(self.lake, self.batch_id)


def _as_declared(df: DataFrame, fields: Mapping[str, str], types: Mapping[str, str]) -> DataFrame:
    """Columns cast to what the table declares, or to what the send names; a bad value becomes null and an error."""
    typed = enforce(df, types)
    rest = {n: kind for n, kind in fields.items() if n not in types}
    own = {f.name: f.dataType.simpleString() for f in df.schema}
    casts = {n: F.col(n).try_cast(kind) if n in own else F.lit(None).cast(kind) for n, kind in rest.items() if own.get(n) != kind}
    bad = [F.when(F.col(n).isNotNull() & casts[n].isNull(), F.array(F.lit(f"TYPE:{n}"))).otherwise(F.array().cast("array<string>"))
           for n in casts if n in own]
    if bad:
        typed = typed.withColumns({**casts, "mdmErrors": F.concat("mdmErrors", *bad)})
    elif casts:
        typed = typed.withColumns(casts)
    return typed


def account(lake: Lake, batch_id: str) -> DataFrame | None:
    """The account of a batch that has ended; None if it has not."""
    path = f"{lake.root}/manifests/batch=_{batch_id}"
    if not path_exists(lake.spark, path):
        return None
    found = lake.spark.read.schema(MANIFEST).json(path).select("batch_id", "total_records", "total_requests")
    return None if found.isEmpty() else found


def send(lake: Lake, df: DataFrame, connector: str, staging: str, crosswalk: Sequence[str] | None, ingest_date: str,
         batch_id: str, **options) -> DataFrame:
    """A batch of one send (``options``: those of ``Batch.send``): its account.

    A batch of this id that has ended is not sent again; its account is returned.
    """
    done = account(lake, batch_id)
    if done is not None:
        return done
    batch = Batch(lake, batch_id)
    batch.send(df, connector, staging, ingest_date, crosswalk, **options)
    return batch.end()
