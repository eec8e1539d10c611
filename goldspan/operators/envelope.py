"""The columns hub records carry besides their own fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldspan.names import GOLDEN_METADATA, REJECTED_COLUMNS, STAGING_METADATA, VALUES
from goldspan.operators.controls import golden_type
from goldspan.sources.lake import source_name


def staging_records(df: DataFrame, connector: str, staging: str, crosswalk: Sequence[str], counter: str,
                    updated: str, deleted: Column | None = None) -> DataFrame:
    """Records as a staging table holds them.

    The id is the source and the crosswalk values: the same natural key gives
    the same id on every send.
    """
    metadata = {
        "mdmCounterForEntity": F.col(counter).cast("long"),
        "mdmId": F.concat_ws("-", F.lit(source_name(connector, staging)), *crosswalk),
        "mdmLastUpdated": F.col(updated),
        "mdmCreated": F.col(updated),
        "mdmConnectorId": F.lit(connector),
        "mdmDeleted": F.lit(False) if deleted is None else deleted,
    }
    return df.select(*[metadata[n].alias(n) for n in STAGING_METADATA], *df.columns)


def _origin(staged: DataFrame, tenant: str, staging: str, crosswalk: Sequence[str], fields: Sequence[str]):
    return {
        "mdmTenantId": F.lit(tenant),
        "mdmCrosswalk": F.create_map(F.lit(staging), F.array(*[F.col(c).cast("string") for c in crosswalk])),
        "mdmStagingRecord": F.struct(*fields),
    }


def golden_records(staged: DataFrame, model: str, tenant: str, staging: str, crosswalk: Sequence[str],
                   fields: Sequence[str]) -> DataFrame:
    """Staging records as golden records of a model: metadata and a struct of its fields."""
    metadata = {n: F.col(n) for n in STAGING_METADATA} | _origin(staged, tenant, staging, crosswalk, fields) | {
        "mdmStagingCounter": F.col("mdmCounterForEntity"),
        "mdmEntityType": F.lit(golden_type(model)),
        "mdmSourceEntityNames": F.array(F.lit(staging)),
        "mdmApplicationIdMasterRecordId": F.array().cast("array<string>"),
        "mdmPreviousIds": F.array().cast("array<string>"),
    }
    return staged.select(*[metadata[n].alias(n) for n in GOLDEN_METADATA], F.struct(*fields).alias(VALUES))


def rejected_records(checked: DataFrame, model: str, tenant: str, staging: str, crosswalk: Sequence[str],
                     fields: Sequence[str]) -> DataFrame:
    """Checked staging records (with ``mdmErrors``) as rows of a model's rejected table."""
    none = F.lit(None).cast("string")
    metadata = {n: F.col(n) for n in STAGING_METADATA} | _origin(checked, tenant, staging, crosswalk, fields) | {
        "mdmErrors": F.col("mdmErrors"),
        "mdmEntityType": F.lit(model + "Rejected"),
        "mdmEntityTemplateId": F.lit(model),
        "mdmStagingEntityName": F.concat_ws("_", "mdmConnectorId", F.lit(staging)),
        "mdmMasterFieldAndValues": F.struct(*fields),
        "mdmDetailFieldValues": none,
        "mdmCreatedUser": none,
        "mdmUpdatedUser": none,
        "mdmStagingApplicationId": none,
    }
    return checked.select(*[metadata[n].alias(n) for n in REJECTED_COLUMNS])
