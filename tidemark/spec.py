"""What to capture: objects, their keys and track, checked when constructed."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from tidemark.fixed import CLASSES, KEY_SOURCES, LAG_HOURS, LOAD_TYPE_PREFIX, OPERATION, \
    RUN_ID_PREFIX, TIMESTAMP, TRACKS
from tidemark.functions.rules import Rule, sql_rule



class SpecError(ValueError):
    """The capture specification cannot be built on; the text names everything that is wrong."""


#: What a part of a spec must be, and the test of it on the whole spec.
Demand = tuple[str, Callable[[Any], bool]]


def _demand(what: str, spec: Any, demands: Iterable[Demand]) -> None:
    broken = [text for text, holds in demands if not holds(spec)]
    if broken:
        raise SpecError(f"{what}: " + "; ".join(broken))


def _one_of(attribute: str, allowed: tuple[str, ...]) -> Demand:
    return f"{attribute} is one of {', '.join(allowed)}", lambda spec: getattr(spec, attribute) in allowed


_OBJECT_DEMANDS: tuple[Demand, ...] = (
    ("name is an upper-case identifier", lambda o: re.fullmatch(r"[A-Z_][A-Z0-9_$]*", o.name)),
    ("keys has a column", lambda o: o.keys),
    _one_of("object_class", CLASSES),
    _one_of("key_source", KEY_SOURCES),
    ("key_override comes with its reason", lambda o: o.key_override_reason or not o.key_override),
)
_CAPTURE_DEMANDS: tuple[Demand, ...] = (
    _one_of("track", TRACKS),
    ("flow_hash is 32 hex digits on the standard track",
     lambda s: s.track != "STANDARD" or re.fullmatch(r"[0-9a-f]{32}", s.flow_hash or "")),
    ("watermark_column is given on the custom track",
     lambda s: s.track != "CUSTOM" or s.watermark_column),
    ("each name of objects stands once", lambda s: len({o.name for o in s.objects}) == len(s.objects)),
    ("referential names captured objects",
     lambda s: not s.referential or {s.referential.master, *s.referential.children} <= {
         o.name for o in s.objects}),
)


@dataclass(frozen=True)
class ObjectSpec:
    name: str
    source: str
    keys: tuple[str, ...]
    object_class: str = "MASTER"
    key_source: str = "inferred"
    key_override: bool = False
    key_override_reason: str | None = None
    nullable_keys: tuple[str, ...] = ()
    cdc_log: bool = False
    lag_hours: float | None = None
    flags: dict[str, Rule] = field(default_factory=dict)
    tiebreak: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        _demand(f"object {self.name!r}", self, _OBJECT_DEMANDS)
        if self.lag_hours is None:
            object.__setattr__(self, "lag_hours", LAG_HOURS[self.object_class])
        if self.object_class == "EMPTY":
            object.__setattr__(self, "cdc_log", False)


@dataclass(frozen=True)
class ReferentialRule:
    master: str
    keys: tuple[str, ...]
    children: tuple[str, ...]


@dataclass(frozen=True)
class CaptureSpec:
    track: str
    objects: tuple[ObjectSpec, ...]
    flow_hash: str | None = None
    watermark_column: str | None = None
    referential: ReferentialRule | None = None
    gold: tuple[Any, ...] = ()

    def __post_init__(self) -> None:
        _demand("capture", self, _CAPTURE_DEMANDS)

    @property
    def watermark(self) -> str:
        return TIMESTAMP if self.track == "STANDARD" else self.watermark_column

    @property
    def operation(self) -> str | None:
        return OPERATION if self.track == "STANDARD" else None

    @property
    def load_type(self) -> str | None:
        return f"{LOAD_TYPE_PREFIX}_{self.flow_hash}" if self.track == "STANDARD" else None

    @property
    def run_id(self) -> str | None:
        return f"{RUN_ID_PREFIX}_{self.flow_hash}" if self.track == "STANDARD" else None

    def object(self, name: str) -> ObjectSpec:
        for o in self.objects:
            if o.name == name:
                return o
        raise KeyError(name)

    @classmethod
    def from_dict(cls, config: Mapping) -> CaptureSpec:
        """Build from the nested mapping a YAML capture configuration loads to."""
        _demand("configuration", config, [
            (f"{part} is given", lambda c, part=part: part in c) for part in ("source", "objects")])
        place = config["source"]
        every = {"cdc_log": bool(config.get("cdc_log", False))}
        objects = tuple(ObjectSpec(**_parts(_placed(raw, place), _OBJECT_PARTS, every))
                        for raw in config["objects"])
        rule = config.get("referential_integrity")
        return cls(objects=objects, **_parts(place, _SOURCE_PARTS, {"track": ""}),
                   referential=ReferentialRule(**_parts(rule, _RULE_PARTS, {"children": ()})) if rule else None)


def _upper(value: Any) -> str:
    return str(value).upper()


def _lower(value: Any) -> str:
    return str(value).lower()


def _rules(flags: Iterable[Mapping]) -> dict[str, Rule]:
    return {flag["name"]: sql_rule(flag["expr"]) for flag in flags}


#: Entry of the configuration, attribute it fills, conversion. Entries that are absent or null keep the default.
_OBJECT_PARTS = (
    ("name", "name", _upper), ("source", "source", str), ("keys", "keys", tuple),
    ("class", "object_class", _upper), ("key_source", "key_source", _lower),
    ("key_override", "key_override", bool), ("key_override_reason", "key_override_reason", str),
    ("nullable_keys", "nullable_keys", tuple), ("cdc_log", "cdc_log", bool),
    ("lag_hours", "lag_hours", float), ("flags", "flags", _rules), ("tiebreak", "tiebreak", tuple),
)
_SOURCE_PARTS = (
    ("track", "track", _upper), ("flow_hash", "flow_hash", str),
    ("watermark_column", "watermark_column", str),
)
_RULE_PARTS = (
    ("master", "master", _upper), ("key_columns", "keys", tuple),
    ("children", "children", lambda names: tuple(map(_upper, names))),
)


def _parts(given: Mapping, table: Iterable[tuple], defaults: Mapping) -> dict[str, Any]:
    return dict(defaults) | {attribute: convert(given[entry]) for entry, attribute, convert in table
                             if given.get(entry) is not None}


def _placed(raw: Mapping, place: Mapping) -> Mapping:
    """An object with its source: its own, or its table under the path of all. No name or key stays empty."""
    under = "/".join([str(place.get("path") or "").rstrip("/"), str(raw.get("table"))])
    return {**raw, "name": raw.get("name") or "", "keys": raw.get("keys") or (),
            "source": raw.get("source") or under}


def silver_objects(spec: CaptureSpec) -> list[ObjectSpec]:
    """Objects that get a Silver table; an EMPTY object stays a Bronze frame."""
    return [o for o in spec.objects if o.object_class != "EMPTY"]


def cdc_objects(spec: CaptureSpec) -> list[ObjectSpec]:
    """Objects whose inserts, updates and deletes are logged."""
    return [o for o in spec.objects if o.cdc_log]
