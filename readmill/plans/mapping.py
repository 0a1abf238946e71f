"""Projections from configuration.

An entry either names a known projection (``handler``) and gives it another topic, table or age limit, or lists its own fields::

    {"name": "fuel", "topic": "fuel-status", "table": "fuel_state",
     "key": {"column": "asset_id", "path": "asset.asset_id"},
     "fields": {"litres": {"path": "tank.litres", "rule": "number"},
                "grade": "tank.grade",
                "state": {"path": "state", "rule": "enum", "names": {1: "OPEN"}, "default": "UNKNOWN"}},
     "origin": {"kind": "fieldwise", "block": "provenance"},
     "asset_ttl_hours": 24}

A field given as text is read as text from that path. The key is the value at its path, or else the message key; a message
with neither is skipped. Upsert tables get ``updated_at``. Everything is checked when the configuration is loaded, so that a
wrong entry stops a deployment rather than a message.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column

from readmill.functions import scalars as S
from readmill.functions import times as TM
from readmill.functions import variants as V
from readmill.operators.retention import resolve_ttl
from readmill.plans.projections import ENVELOPE, Message, Projection, get_projection

Spec = Mapping[str, object]

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_PATH = re.compile(rf"{_NAME.pattern}(\.{_NAME.pattern})*")
_RESERVED = {
    *ENVELOPE, "v", "decode_error", "handler_error", "skipped", "write_error", "outcome", "provenance_fallback",
    "edge_id", "region_id", "updated_at",
}
_LIMITS = ("retention_hours", "asset_ttl_hours")
_SHARED = ("topic", "table", "decode_as", "mode", *_LIMITS)


@dataclass(frozen=True)
class Rule:
    """How a field becomes a column, and which values are failures of the message."""

    read: Callable[[Message, str, Spec], Column]
    options: tuple[str, ...] = ()
    whole: bool = False
    variant: bool = False
    bad: Callable[[V.Field], Column] | None = None
    complaint: str = ""


def _names(spec: Spec) -> dict[int, str]:
    return {int(number): str(name) for number, name in dict(spec.get("names") or {}).items()}


#: Rules by name; a user's own are added like any entry of a dictionary.
RULES: dict[str, Rule] = {
    "text": Rule(lambda m, p, s: m.text(p)),
    "truthy_text": Rule(lambda m, p, s: V.truthy_text(m.at(p))),
    "flag": Rule(lambda m, p, s: V.truthy(m.at(p))),
    "boolean": Rule(lambda m, p, s: m.at(p).boolean),
    "whole": Rule(lambda m, p, s: V.integer(m.at(p)), whole=True),
    "count": Rule(lambda m, p, s: S.count_or_zero(m.at(p)), whole=True),
    "number": Rule(lambda m, p, s: V.floating(m.at(p))),
    "instant": Rule(lambda m, p, s: TM.instant_field(m.at(p))),
    "ns_instant": Rule(
        lambda m, p, s: TM.positive_instant(m.ns_seconds(p)), bad=TM.ns_out_of_range, complaint="is out of range"
    ),
    "seconds": Rule(
        lambda m, p, s: TM.duration_seconds(m.at(p)), bad=TM.bad_duration, complaint="is not a finite duration"
    ),
    "enum": Rule(lambda m, p, s: S.enum_name(m.at(p), _names(s), s.get("default")), options=("names", "default")),
    "list": Rule(lambda m, p, s: V.or_default(m.block(p), "[]"), variant=True),
    "object": Rule(lambda m, p, s: V.or_default(m.block(p), "{}"), variant=True),
    "blob": Rule(lambda m, p, s: m.block(p).variant, variant=True),
}


def _require(ok: bool, name: object, text: str) -> None:
    if not ok:
        raise ValueError(f"projection {name!r}: {text}")


def _known_keys(name: object, what: str, block: object, allowed: Sequence[str]) -> None:
    _require(isinstance(block, Mapping), name, f"{what} must be a mapping, not {block!r}")
    unknown = sorted(set(map(str, block)) - set(allowed))
    _require(not unknown, name, f"{what} does not know {', '.join(unknown)}")


def _matches(pattern: re.Pattern, value: object) -> bool:
    return isinstance(value, str) and pattern.fullmatch(value) is not None


def _shared(name: object, entry: Spec) -> dict[str, object]:
    """The settings both kinds of entry may have, checked."""
    found = {k: entry[k] for k in _SHARED if entry.get(k) is not None}
    for key in ("topic", "table", "decode_as"):
        _require(isinstance(found.get(key, "-"), str) and found.get(key, "-") != "", name, f"{key} must be a text")
    _require("/" not in found.get("table", ""), name, "table must not hold a slash")
    _require(found.get("mode", "upsert") in ("upsert", "append"), name, f"mode is {found.get('mode')!r}, but must be upsert or append")
    for key in _LIMITS:
        hours = found.get(key, 0)
        _require(type(hours) is int and hours >= 0, name, f"{key} must be a whole number of hours, not {hours!r}")
    return found


def _from_handler(entry: Spec) -> Projection:
    name = entry.get("name", entry["handler"])
    _known_keys(name, "the entry", entry, ("name", "handler", "consumer_group", *_SHARED))
    try:
        known = get_projection(entry["handler"])
    except KeyError as error:
        raise ValueError(f"projection {name!r}: {error.args[0]}") from None
    found = _shared(name, entry)
    _require(found.get("mode", known.mode) == known.mode, name, f"{known.name} is an {known.mode} projection")
    # Limits that the entry leaves out are off: they belong to the deployment, not to the handler.
    limits = dict.fromkeys(_LIMITS) | {k: found[k] for k in _LIMITS if found.get(k)}
    return replace(known, **{**found, **limits, "name": name})


def _field(name: object, column: str, spec: object) -> tuple[str, Rule, Spec]:
    spec = {"path": spec} if isinstance(spec, str) else spec
    _require(_matches(_NAME, column) and not column.startswith("_"), name, f"{column!r} cannot be a column")
    _require(column not in _RESERVED, name, f"the column {column} is made by the library")
    _require(isinstance(spec, Mapping), name, f"{column} must be a path or a mapping")
    rule = RULES.get(spec.get("rule", "text"))
    _require(rule is not None, name, f"{column} has the rule {spec.get('rule')!r}, but it must be one of {', '.join(sorted(RULES))}")
    _known_keys(name, column, spec, ("path", "rule", *rule.options))
    _require(_matches(_PATH, spec.get("path")), name, f"{column} has no usable path: {spec.get('path')!r}")
    return spec["path"], rule, spec


def _origin(name: object, key: str, block: Spec | None) -> dict[str, object]:
    if block is None:
        return {}
    _known_keys(name, "origin", block, ("kind", "block", "position"))
    kind, path = block.get("kind"), block.get("block", "")
    _require(kind in ("fieldwise", "pair"), name, f"origin is of kind {kind!r}, but must be fieldwise or pair")
    _require(path == "" or _matches(_PATH, path), name, f"origin has no usable block: {path!r}")
    _require(kind == "fieldwise" or key == "asset_id", name, "an origin of kind pair needs the key asset_id")
    found: dict[str, object] = {"origin": kind, "origin_block": lambda m: m.at(path)}
    position = block.get("position")
    if position is not None:
        _known_keys(name, "position", position, ("lat", "lon"))
        lat, lon = position.get("lat"), position.get("lon")
        _require(kind == "pair", name, "only an origin of kind pair has a position")
        _require(_matches(_PATH, lat) and _matches(_PATH, lon), name, "position needs the paths lat and lon")
        found["position"] = lambda m: (V.floating(m.at(lat)), V.floating(m.at(lon)))
    return found


def _from_fields(entry: Spec) -> Projection:
    name = entry.get("name")
    _require(isinstance(name, str) and name != "", name, "an entry without a handler needs a name")
    _known_keys(name, "the entry", entry, ("name", "consumer_group", "key", "fields", "origin", *_SHARED))
    found = {"decode_as": "json", "mode": "upsert"} | _shared(name, entry)
    for wanted in ("topic", "table"):
        _require(wanted in found, name, f"{wanted} is missing")
    key = entry.get("key")
    _known_keys(name, "key", key, ("column", "path"))
    column, path = key.get("column"), key.get("path", key.get("column"))
    _require(_matches(_NAME, column) and column not in _RESERVED and not column.startswith("_"), name, f"the key column cannot be {column!r}")
    _require(_matches(_PATH, path), name, f"the key has no usable path: {path!r}")
    _require(isinstance(entry.get("fields"), Mapping), name, "fields must be a mapping")
    fields = {c: _field(name, c, spec) for c, spec in entry["fields"].items()}
    _require(column not in fields, name, f"{column} is the key and a field")
    if found["mode"] == "append":
        timed = fields.get("time")
        _require(timed is not None and timed[1] in (RULES["instant"], RULES["ns_instant"]), name, "an event log needs a field time that is an instant")

    def columns(m: Message) -> dict[str, Column]:
        made = {c: rule.read(m, at, spec) for c, (at, rule, spec) in fields.items()}
        return made | ({"updated_at": m.as_of} if found["mode"] == "upsert" else {})

    def late_errors(m: Message) -> list[tuple[Column, str]]:
        return [(rule.bad(m.at(at)), f"{at} {rule.complaint}") for at, rule, _ in fields.values() if rule.bad is not None]

    return Projection(
        name=name, keys=(column,), key_path=path, columns=columns, skip=lambda m: m.id_or_key(path).isNull(),
        late_errors=late_errors,
        integers=tuple(dict.fromkeys(at for at, rule, _ in fields.values() if rule.whole)),
        variants=tuple(c for c, (_, rule, _) in fields.items() if rule.variant),
        **found, **_origin(name, column, entry.get("origin")),
    )


def configured_projections(entries: Sequence[Spec], ttl_override: int | None = None) -> dict[str, Projection]:
    """Projections of a configuration by name, in its order; ``ttl_override`` as in ``retention.resolve_ttl``."""
    made: list[Projection] = []
    for entry in entries:
        _require(isinstance(entry, Mapping), entry, "an entry must be a mapping")
        made.append(_from_handler(entry) if entry.get("handler") is not None else _from_fields(entry))
    for what in ("name", "table"):
        values = [getattr(p, what) for p in made]
        for p in made:
            _require(values.count(getattr(p, what)) == 1, p.name, f"the {what} {getattr(p, what)} is given twice")
    return {p.name: p for p in resolve_ttl(made, ttl_override)}
