"""Names, limits and formats that are the contract of the captured tables."""

# Connector metadata on standard-track tables.
OPERATION = "__OPERATION_TYPE"
TIMESTAMP = "__TIMESTAMP"
LOAD_TYPE_PREFIX = "load_type"
RUN_ID_PREFIX = "run_id"
FLOW_HASH_SUFFIX = r"_([0-9a-f]{32})$"

# Replication timestamp names tried first on custom-track tables,
# then name fragments that mark a temporal column as a load or change stamp.
WATERMARK_NAMES = (
    "ZZLASTCHGDATE", "ZZ_LAST_CHG_DATE", "ZZLASTCHANGEDATE", "ZZUPDATED_AT",
    "ZZLOADTS", "ZZ_LOAD_TS", "_LOAD_TS", "LAST_REPLICATED_AT", "REPLICATION_TS",
)
WATERMARK_HINTS = (
    "lastchg", "lastchange", "loadts", "load_ts", "replicat", "extract",
    "ingest", "_ts", "updated",
)

# Name fragments of indicator columns, and what a masked value reads as.
INDICATOR_HINTS = ("block", "indicator", "flag", "deletion")
MASKS = ("********", "***MASKED***")

# Limits for trusting change metadata and for the readiness checks.
MAX_OPERATIONS = 12
MAX_OPERATION_LENGTH = 2
FAULT_OPERATION = "operation column is not a change code"
FAULT_TIMESTAMP = "timestamp column does not parse"
FAULT_SAME_VALUE = "metadata columns hold the same value"
FAULT_NO_HASH = "load type carries no flow hash"
MERGE_SHARE = 0.98
PRUNE_NEAR_COMPLETE = 0.02
PRUNE_PARTIAL = 0.35
FILE_COUNT_RATIO = 0.7
STALE_DRAIN_DAYS = 14

# Lineage columns of Silver and the classes of captured objects.
LINEAGE = (
    "CDC_OPERATION", "CDC_LOAD_TYPE", "CDC_RUN_ID",
    "CDC_TIMESTAMP_TEXT", "CDC_TIMESTAMP_UTC",
)
TRACKS = ("STANDARD", "CUSTOM")
CLASSES = ("MASTER", "TRANSACTION", "EMPTY")
KEY_SOURCES = ("declared", "inferred")
LAG_HOURS = {"MASTER": 24, "TRANSACTION": 1, "EMPTY": None}
