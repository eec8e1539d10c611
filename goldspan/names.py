"""Names and lists that stored hub data already uses."""

STAGING_METADATA = [
    "mdmCounterForEntity", "mdmId", "mdmLastUpdated", "mdmCreated",
    "mdmConnectorId", "mdmDeleted",
]

GOLDEN_METADATA = [
    "mdmCounterForEntity", "mdmStagingCounter", "mdmId", "mdmCreated",
    "mdmLastUpdated", "mdmTenantId", "mdmEntityType", "mdmSourceEntityNames",
    "mdmCrosswalk", "mdmStagingRecord", "mdmApplicationIdMasterRecordId",
    "mdmPreviousIds", "mdmDeleted",
]

REJECTED_COLUMNS = [
    "mdmConnectorId", "mdmCreated", "mdmCreatedUser", "mdmCrosswalk",
    "mdmDetailFieldValues", "mdmEntityTemplateId", "mdmEntityType",
    "mdmErrors", "mdmId", "mdmLastUpdated", "mdmMasterFieldAndValues",
    "mdmStagingApplicationId", "mdmStagingEntityName", "mdmStagingRecord",
    "mdmTenantId", "mdmUpdatedUser",
]

# The counter that settles which version of a record is the latest.
GOLDEN_TIE_BREAK = "mdmStagingCounter"
STAGING_TIE_BREAK = "mdmCounterForEntity"

# Columns every lake scan returns, asked for or not.
SCAN_KEYS = ["mdmCounterForEntity", "mdmId"]

# The struct that holds a golden record's own fields.
VALUES = "mdmGoldenFieldAndValues"

LAKE_SPACES = [
    "golden", "staging", "staging_master", "staging_rejected", "view", "app",
    "staging_cds", "golden_cds", "view_cds", "golden_rejected",
]

# Severity names as logs carry them, and the names they are stored under.
LOG_LEVELS = {
    "NOTSET": "NOTSET", "DEBUG": "DEBUG", "INFO": "INFO", "WARNING": "WARN",
    "WARN": "WARN", "ERROR": "ERROR", "CRITICAL": "ERROR", "FATAL": "ERROR",
}
LOG_ORDER = ["NOTSET", "DEBUG", "INFO", "WARN", "ERROR"]

# Declared field types and the Spark type each one is kept in.
FIELD_TYPES = {
    "boolean": "boolean",
    "integer": "bigint",
    "long": "bigint",
    "double": "double",
    "string": "string",
    "enum": "string",
    "date": "timestamp",
    "binary": "binary",
    "base64": "binary",
    "geopoint": "struct<lat:double,lon:double>",
}
