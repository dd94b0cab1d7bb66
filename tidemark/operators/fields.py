"""What the columns of a source are for, read off one table of rules.

Each field takes the first rule it meets, so a metadata column is never an
indicator, and a named replication stamp never a guessed one.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType, DateType, StringType, StructField, StructType, TimestampNTZType, TimestampType,
)

from tidemark.fixed import (
    FLOW_HASH_SUFFIX, INDICATOR_HINTS, LOAD_TYPE_PREFIX, OPERATION, RUN_ID_PREFIX, TIMESTAMP,
    WATERMARK_HINTS, WATERMARK_NAMES,
)


@dataclass(frozen=True)
class Rule:
    """A role with what a name must match, whole or in part, and the types it must have."""

    role: str
    pattern: str
    kinds: tuple[type, ...] = ()
    cased: bool = False

    def fits(self, field: StructField) -> bool:
        found = re.search(self.pattern, field.name, 0 if self.cased else re.IGNORECASE)
        return found is not None and (not self.kinds or isinstance(field.dataType, self.kinds))


def _one_of(names: tuple[str, ...]) -> str:
    return "|".join(map(re.escape, names))


RULES = (
    Rule("operation", f"^{OPERATION}$"),
    Rule("timestamp", f"^{TIMESTAMP}$"),
    Rule("load_type", f"^{LOAD_TYPE_PREFIX}(_|$)"),
    Rule("run_id", f"^{RUN_ID_PREFIX}(_|$)"),
    Rule("watermark", f"^({_one_of(WATERMARK_NAMES)})$"),
    Rule("stamp", _one_of(WATERMARK_HINTS), (DateType, TimestampType, TimestampNTZType)),
    Rule("indicator", "", (BooleanType,)),
    Rule("indicator", _one_of(INDICATOR_HINTS), (StringType,)),
    Rule("indicator", "^[iI][sS][A-Z]", cased=True),
)
METADATA = ("operation", "timestamp", "load_type", "run_id")


def roles(schema: StructType) -> dict[str, list[str]]:
    """Columns by role, in schema order; columns without a role are under ''."""
    found: dict[str, list[str]] = defaultdict(list)
    for f in schema.fields:
        found[next((r.role for r in RULES if r.fits(f)), "")].append(f.name)
    return found


@dataclass(frozen=True)
class Signal:
    """The metadata columns by which a standard-track table tells its changes."""

    operation: str
    timestamp: str
    load_type: str | None = None
    run_id: str | None = None

    @property
    def flow_hash(self) -> str | None:
        found = re.search(FLOW_HASH_SUFFIX, self.load_type or "", re.IGNORECASE)
        return found and found[1]

    @property
    def hash_suffixed(self) -> bool:
        """A load type without the hash hints at a copy of a shared table."""
        return bool(self.flow_hash)


def standard_signal(schema: StructType) -> Signal | None:
    """The signal, if the schema has both the operation and its time."""
    found = roles(schema)
    if not (found["operation"] and found["timestamp"]):
        return None
    return Signal(*[next(iter(found[part]), None) for part in METADATA])


def find_watermark(schema: StructType) -> str | None:
    """The replication timestamp: known names in their order, then stamps that read like one."""
    found = roles(schema)
    known = [n.lower() for n in WATERMARK_NAMES]
    return next(iter(sorted(found["watermark"], key=lambda c: known.index(c.lower())) + found["stamp"]), None)


def track_of(schema: StructType) -> str:
    """Deletes come with the standard signal alone, so it goes before a watermark."""
    tracks = {"STANDARD": standard_signal, "CUSTOM": find_watermark}
    return next((t for t, signal in tracks.items() if signal(schema)), "NONE")


def metadata_columns(schema: StructType) -> set[str]:
    found = roles(schema)
    return {c for part in METADATA for c in found[part]}


def indicator_columns(schema: StructType) -> list[str]:
    """Columns that look like flags: booleans, and names that say so."""
    return roles(schema)["indicator"]
