"""The topic -> table projections.

A projection only names columns over the decoded message ``v``; everything else
(decoding, outcomes, origin, sinks) is shared. All of it is one ``select`` over the
decoded stream, so a projection adds no shuffle unless its origin strategy does.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readmill.functions import scalars as S
from readmill.functions import times as TM
from readmill.functions import variants as V
from readmill.operators import quarantine
from readmill.operators.assignment import Asset
from readmill.operators.provenance import Resolver, fieldwise, message_pair, pair_or_derive

ENVELOPE = ("topic", "partition", "offset", "key", "value")

# The enum numbers known from the contract; callers pass their own full maps.
LIFECYCLE_NAMES = {2: "LIFECYCLE_ACTIVE"}
STATUS_NAMES = {4: "CONFIG_STATUS_NOT_MISSION_CAPABLE"}


@dataclass(frozen=True)
class Message:
    """What a projection may read."""

    v: Column
    key: Column
    as_of: Column
    enums: Mapping[str, Mapping[int, str]]
    # Columns computed before the projection, by level: texts, values, values of values.
    shared: tuple[dict[str, Column], ...] = field(default_factory=lambda: ({}, {}, {}))

    def once(self, name: str, value: Column, level: int = 1) -> Column:
        """A value computed once and used several times; it may use lower levels."""
        self.shared[level][f"_{name}"] = value
        return F.col(f"_{name}")

    def read_once(self, name: str, value: Column) -> Column:
        return self.once(name, value, level=0)

    def ns_seconds(self, path: str) -> Column:
        n = self.once(path, V.integer(self.at(path)))
        return self.once(f"{path}_seconds", TM.ns_seconds(self.at(path), n), level=2)

    def at(self, path: str = "") -> V.Field:
        """A scalar, or the way to scalars: their texts are read once."""
        return V.Field(self.v, f".{path}" if path else "", self.read_once)

    def block(self, path: str) -> V.Field:
        """An object or array: nothing is read before it is needed."""
        return V.field(self.v, path)

    def text(self, path: str) -> Column:
        return self.at(path).text

    def id_or_key(self, path: str) -> Column:
        found = F.coalesce(V.truthy_text(self.at(path)), F.nullif(self.key, F.lit("")))
        return self.once(f"id_{path.replace('.', '_')}", found)


Check = Callable[[Message], list[tuple[Column, str]]]


def _no_checks(_: Message) -> list[tuple[Column, str]]:
    return []


@dataclass(frozen=True)
class Projection:
    name: str
    topic: str
    table: str
    decode_as: str
    mode: str
    keys: tuple[str, ...]
    columns: Callable[[Message], dict[str, Column]]
    skip: Callable[[Message], Column]
    # Producer errors found before the skip rule is reached, and after it.
    early_errors: Check = _no_checks
    late_errors: Check = _no_checks
    # Where the first key column is read, with the message key as its default; None: ``columns`` makes it.
    key_path: str | None = None
    integers: tuple[str, ...] = ()
    # "fieldwise" or "pair" and the block holding the message's own origin.
    origin: str | None = None
    origin_block: Callable[[Message], V.Field] | None = None
    position: Callable[[Message], tuple[Column, Column]] | None = None
    retention_hours: int | None = None
    asset_ttl_hours: int | None = None
    variants: tuple[str, ...] = field(default=())


def _objects(**usual: str) -> Check:
    """Blocks that must be objects, each with an entry it usually has."""
    return lambda m: [
        (V.not_object(m.block(p), entry), f"{p} is not an object") for p, entry in usual.items()
    ]


def _missing(id_column: Callable[[Message], Column]) -> Callable[[Message], Column]:
    return lambda m: id_column(m).isNull()


def _asset_id(path: str = "asset_id") -> Callable[[Message], Column]:
    return lambda m: m.id_or_key(path)


# ------------------------------------------------------------- asset projections


def _cm_state(m: Message) -> dict[str, Column]:
    lifecycle = m.enums.get("lifecycle", LIFECYCLE_NAMES)
    status = m.enums.get("status", STATUS_NAMES)
    return {
        "baseline_id": m.text("baseline_id"),
        "lifecycle": S.enum_name(m.at("lifecycle"), lifecycle, "LIFECYCLE_UNSPECIFIED"),
        "overall_status": S.enum_name(m.at("overall_status"), status, "CONFIG_STATUS_UNSPECIFIED"),
        "last_alerted_status": S.enum_name(m.at("last_alerted_status"), status, None),
        "as_of": TM.positive_instant(m.ns_seconds("as_of_ns")),
        "last_observed_at": TM.positive_instant(m.ns_seconds("last_observed_at_ns")),
        "installed": V.or_default(m.block("installed"), "[]"),
        "mod_status": V.or_default(m.block("mod_status"), "[]"),
        "discrepancies": V.or_default(m.block("discrepancies"), "[]"),
        "manual_discrepancies": V.or_default(m.block("manual_discrepancies"), "[]"),
        "updated_at": m.as_of,
    }


def _ns_in_range(*paths: str) -> Check:
    return lambda m: [(TM.ns_out_of_range(m.at(p)), f"{p} is out of range") for p in paths]


def _logistics_status(m: Message) -> dict[str, Column]:
    return {
        "platform_variant": m.text("status.platform_variant"),
        "overall_severity": F.when(
            m.at("status.overall_severity").variant.isNull(), "LOGISTICS_SEVERITY_UNSPECIFIED"
        ).otherwise(m.text("status.overall_severity")),
        "previous_severity": m.text("previous_severity"),
        "constraining_factors": V.or_default(m.block("status.constraining_factors"), "[]"),
        "projected_mission_capable_remaining_seconds": TM.duration_seconds(
            m.at("status.projected_mission_capable_remaining")
        ),
        "projected_time_to_next_constraint_seconds": TM.duration_seconds(
            m.at("status.projected_time_to_next_constraint")
        ),
        "cm_baseline_id": m.text("status.cm_baseline_id"),
        "status_revision": S.count_or_zero(m.at("status.status_revision")),
        "computed_at": TM.instant_field(m.at("status.computed_at")),
        "latest_telemetry_sample_time": TM.instant_field(
            m.at("status.latest_telemetry_sample_time")
        ),
        "is_transition": V.truthy(m.at("is_transition")),
        "is_initial": V.truthy(m.at("is_initial")),
        "updated_at": m.as_of,
    }


def _logistics_late(m: Message) -> list[tuple[Column, str]]:
    durations = (
        "status.projected_mission_capable_remaining",
        "status.projected_time_to_next_constraint",
    )
    return _objects(provenance="edge_id")(m) + [
        (TM.bad_duration(m.at(p)), f"{p} is not a finite duration") for p in durations
    ]


def _telemetry_latest(m: Message) -> dict[str, Column]:
    state = "operational_state."
    return {
        "platform_variant": m.text("asset.platform_variant"),
        "callsign": m.text("asset.callsign"),
        "force_id": m.text("asset.force"),
        "kinematics": m.block("kinematics").variant,
        "sustainment": m.block("sustainment").variant,
        "provenance": V.or_falsy(m.block("provenance"), "{}"),
        "last_sample_at": TM.instant_field(m.at("provenance.sample_time")),
        "schema_revision": S.count_or_zero(m.at("schema_revision")),
        "power_state": m.text(state + "power_state"),
        "functional_mode": m.text(state + "functional_mode"),
        "health_state": m.text(state + "health_state"),
        "actively_receiving": m.at(state + "actively_receiving").boolean,
        "actively_transmitting": m.at(state + "actively_transmitting").boolean,
        "updated_at": m.as_of,
    }


def _position(m: Message) -> tuple[Column, Column]:
    """As ``wgs84``, with its parts computed once."""
    block = m.block("kinematics.position")
    nested = m.once("nested", V.truthy_block(block / "wgs84"))
    parts = [
        m.once(f"{name}_{kind}", part, level=2)
        for name in ("latitude", "longitude")
        for kind, part in zip(("value", "bad"), S.coordinate(block, nested, name, name[:3]))
    ]
    usable = ~(parts[1] | parts[3])
    return F.when(usable, parts[0]), F.when(usable, parts[2])


def _telemetry_late(m: Message) -> list[tuple[Column, str]]:
    return _objects(provenance="edge_id", operational_state="power_state")(m) + [
        (V.not_object(m.block("kinematics.position"), "lat"), "kinematics.position is not an object")
    ]


def _telemetry_windows(m: Message) -> dict[str, Column]:
    return {
        "platform_variant": m.text("platform_variant"),
        "fluid_trends": V.or_default(m.block("fluid_trends"), "[]"),
        "consumable_trends": V.or_default(m.block("consumable_trends"), "[]"),
        "component_wear_trends": V.or_default(m.block("wear_trends"), "[]"),
        "window_duration_seconds": _window_duration(m, TM.duration_seconds),
        "sample_count": V.integer(m.at("window.sample_count")),
        "computed_at": TM.instant_field(m.at("computed_at")),
        "updated_at": m.as_of,
    }


def _window_duration(m: Message, read: Callable[[V.Field], Column]) -> Column:
    first, second = m.at("window.duration"), m.at("window.window_duration")
    return F.when(V.truthy(first), read(first)).otherwise(read(second))


def _windows_late(m: Message) -> list[tuple[Column, str]]:
    samples = m.at("window.sample_count")
    # Here even an empty text is an error: only null and absent mean "unknown".
    return _objects(window="sample_count", provenance="edge_id")(m) + [
        (_window_duration(m, TM.bad_duration), "window duration is not a finite duration"),
        (
            samples.text.isNotNull() & V.wide_integer(samples).isNull(),
            "window.sample_count is not a whole number",
        ),
    ]


def _capability_state(m: Message) -> dict[str, Column]:
    return {
        "capabilities": V.or_default(m.block("capabilities"), "[]"),
        "schema_version": m.text("schema_version"),
        "mode": m.text("mode"),
        "observed_at": TM.instant_field(m.at("observed_at")),
        "updated_at": m.as_of,
    }


def _element_telemetry(m: Message) -> dict[str, Column]:
    return {
        "platform_variant": F.coalesce(V.truthy_text(m.at("platform_variant")), F.lit("")),
        "profile_name": F.coalesce(V.truthy_text(m.at("profile_name")), F.lit("")),
        "elements": V.or_falsy(m.block("elements"), "[]"),
        "operational": V.or_falsy(m.block("operational"), "{}"),
        "observed_at": F.coalesce(TM.seconds_instant(m.ns_seconds("observed_at_ns")), m.as_of),
        "updated_at": m.as_of,
    }


def _inventory_ids(m: Message) -> tuple[Column, Column]:
    def clean(path: str) -> Column:
        stripped = F.nullif(S.strip(V.truthy_text(m.at(path))), F.lit(""))
        return m.once(f"stripped_{path}", stripped)

    return clean("asset_id"), clean("layer_name")


def _inventory(m: Message) -> dict[str, Column]:
    asset_id, layer = _inventory_ids(m)
    return {
        "id": S.row_id(asset_id, layer),
        "name": layer,
        "asset_id": asset_id,
        "layer_name": layer,
        "available_count": S.count_or_zero(m.at("available_count")),
        "allocated_count": S.count_or_zero(m.at("allocated_count")),
        "updated_at": m.as_of,
    }


def _inventory_early(m: Message) -> list[tuple[Column, str]]:
    return [
        (V.truthy(m.at(p)) & ~V.is_string(m.at(p)), f"{p} is not text")
        for p in ("asset_id", "layer_name")
    ]


# ------------------------------------------------------------------------ events


def _tactical_events(m: Message) -> dict[str, Column]:
    return {
        "id": m.text("id"),
        "source": m.text("source"),
        "type": m.text("type"),
        "subject": F.coalesce(V.truthy_text(m.at("subject")), m.key, F.lit("")),
        "severity": S.severity(m.at()),
        "time": TM.instant_field(m.at("time")),
        "data": V.or_default(m.block("data"), "{}"),
        "ingested_at": m.as_of,
    }


# ----------------------------------------------------------------------- regions


# The fleet buckets of a region summary.
FLEET_BUCKETS = ("nominal", "degraded", "critical", "non_operational", "asset_count")


def _fleet_summary(m: Message) -> dict[str, Column]:
    return {
        **{name: S.count_or_zero(m.at(name)) for name in FLEET_BUCKETS},
        "observed_at": TM.instant_field(m.at("observed_at")),
        "updated_at": m.as_of,
    }


def _region_list(name: str) -> Callable[[Message], dict[str, Column]]:
    return lambda m: {
        name: V.or_falsy(m.block(name), "[]"),
        "observed_at": TM.instant_field(m.at("observed_at")),
        "updated_at": m.as_of,
    }


def _region(name: str, topic: str, message: str, columns, **more) -> Projection:
    return Projection(
        name=name, topic=topic, table=name, decode_as=message, mode="upsert",
        keys=("region_id",), key_path="region_id", columns=columns, skip=_missing(_asset_id("region_id")), **more,
    )


def _asset(name, topic, table, decode_as, columns, id_path="asset_id", **more) -> Projection:
    return Projection(
        name=name, topic=topic, table=table, decode_as=decode_as, mode="upsert",
        keys=("asset_id",), key_path=id_path, columns=columns, skip=_missing(_asset_id(id_path)),
        asset_ttl_hours=24, **more,
    )


_ALL = (
    _asset(
        "cm_state", "asset-cm-state", "asset_cm_state", "json", _cm_state,
        late_errors=_ns_in_range("as_of_ns", "last_observed_at_ns"),
        origin="fieldwise", origin_block=lambda m: m.at(),
        variants=("installed", "mod_status", "discrepancies", "manual_discrepancies"),
    ),
    _asset(
        "logistics_status", "asset-logistics-status", "asset_logistics_status",
        "AssetLogisticsStatusUpdate", _logistics_status, id_path="status.asset_id",
        early_errors=_objects(status="asset_id"), late_errors=_logistics_late,
        integers=("status.status_revision",),
        origin="pair", origin_block=lambda m: m.at("provenance"),
        variants=("constraining_factors",),
    ),
    _asset(
        "telemetry_latest", "telemetry-latest-state", "telemetry_latest_state",
        "EntityTelemetryEvent", _telemetry_latest, id_path="asset.asset_id",
        early_errors=_objects(asset="asset_id"), late_errors=_telemetry_late,
        integers=("schema_revision",),
        origin="pair", origin_block=lambda m: m.at("provenance"),
        position=_position,
        variants=("kinematics", "sustainment", "provenance"),
    ),
    Projection(
        name="tactical_events", topic="tactical-events", table="tactical_events",
        decode_as="cloudevents.json", mode="append", keys=("id",),
        columns=_tactical_events, skip=lambda m: ~V.truthy(m.at("id")),
        origin="fieldwise", origin_block=lambda m: m.at("data"), retention_hours=24,
        variants=("data",),
    ),
    _asset(
        "telemetry_windows", "asset-telemetry-windows", "asset_telemetry_windows",
        "WindowedTelemetry", _telemetry_windows, late_errors=_windows_late,
        origin="fieldwise", origin_block=lambda m: m.at("provenance"),
        variants=("fluid_trends", "consumable_trends", "component_wear_trends"),
    ),
    _region(
        "region_fleet_summary", "region-fleet-summary", "RegionFleetSummary",
        _fleet_summary, integers=FLEET_BUCKETS,
    ),
    _region(
        "region_top_factors", "region-top-factors", "RegionTopFactors",
        _region_list("factors"), variants=("factors",),
    ),
    _region(
        "region_wear_trends", "region-wear-trends", "RegionWearTrends",
        _region_list("components"), variants=("components",),
    ),
    _asset(
        "capability_state", "asset-capability-snapshot", "asset_capability_state", "json",
        _capability_state, late_errors=_objects(provenance="edge_id"),
        origin="pair", origin_block=lambda m: m.at("provenance"),
        variants=("capabilities",),
    ),
    Projection(
        name="asset_element_telemetry", topic="asset-element-telemetry",
        table="asset_element_telemetry", decode_as="json", mode="upsert",
        keys=("asset_id",), key_path="asset_id", columns=_element_telemetry,
        skip=lambda m: m.id_or_key("asset_id").isNull()
        | V.not_array(m.block("elements")),
        origin="pair", asset_ttl_hours=24, variants=("elements", "operational"),
    ),
    Projection(
        name="asset_element_inventory", topic="asset-element-inventory",
        table="inventory_items", decode_as="json", mode="upsert", keys=("id",),
        columns=_inventory, early_errors=_inventory_early,
        skip=lambda m: _inventory_ids(m)[0].isNull() | _inventory_ids(m)[1].isNull(),
        asset_ttl_hours=24,
    ),
)

PROJECTIONS: dict[str, Projection] = {p.name: p for p in _ALL}


def register_projection(projection: Projection) -> Projection:
    PROJECTIONS[projection.name] = projection
    return projection


def narrowed(projection: Projection, only: Sequence[str]) -> Projection:
    """The projection with no more than its keys and the named columns; all its checks stay."""
    wanted = {*projection.keys, *only}
    return replace(projection, columns=lambda m: {n: c for n, c in projection.columns(m).items() if n in wanted})


def get_projection(name: str) -> Projection:
    if name not in PROJECTIONS:
        raise KeyError(f"unknown projection {name!r} (registered: {sorted(PROJECTIONS)})")
    return PROJECTIONS[name]


# ----------------------------------------------------------------------- shared


def _first_error(checks: list[tuple[Column, str]]) -> Column:
    none = F.lit(None).cast("string")
    return F.coalesce(*[F.when(bad, F.lit(text)) for bad, text in checks], none)


def project(
    decoded: DataFrame,
    projection: Projection,
    resolver: Resolver = Resolver(),
    as_of: Column | None = None,
    enums: Mapping[str, Mapping[int, str]] | None = None,
) -> DataFrame:
    """Decoded messages -> envelope, ``outcome``, error texts and the table's columns.

    Every message keeps one row, so failures can be quarantined from the same pass.
    """
    # Keys are text; one that is not is a failure of the message, not of the batch.
    valid_key = F.try_validate_utf8(F.col("key").cast("string"))
    bad_key = F.col("key").isNotNull() & valid_key.isNull()
    key_text = F.coalesce(valid_key, F.lit(""))
    m = Message(
        F.col("v"), F.col("_key"), F.current_timestamp() if as_of is None else as_of, enums or {}
    )
    m.read_once("key", key_text)
    skip = F.coalesce(projection.skip(m), F.lit(False))
    early = _first_error(projection.early_errors(m))
    wrong = [(V.bad_integer(m.at(p)), f"{p} is not a whole number") for p in projection.integers]
    late = _first_error(projection.late_errors(m) + wrong)
    overflow = _first_error(
        [(V.integer_overflow(m.at(p)), f"{p} is out of range") for p in projection.integers]
    )
    columns = projection.columns(m)
    if projection.key_path is not None:
        columns = {projection.keys[0]: m.id_or_key(projection.key_path)} | columns

    has_value = F.col("v").isNotNull() & ~bad_key
    status = {
        "decode_error": F.coalesce(F.col("decode_error"), F.when(bad_key, F.lit("message key is not UTF-8"))),
        "handler_error": F.when(has_value, F.coalesce(early, F.when(~skip, late))),
        "skipped": has_value & early.isNull() & skip,
        "write_error": F.when(has_value, overflow),
    }
    extra: dict[str, Column] = {}
    if projection.origin is not None:
        block = projection.origin_block(m) if projection.origin_block else None
        none = F.lit(None).cast("string")
        edge, region = message_pair(block) if block is not None else (none, none)
        if projection.origin == "fieldwise":
            edge, region, missing = fieldwise(edge, region, resolver.defaults)
            columns |= {"edge_id": edge, "region_id": region}
            extra["provenance_fallback"] = missing
        else:
            lat, lon = projection.position(m) if projection.position else (None, None)
            number = F.lit(None).cast("double")
            extra |= {
                "_edge": edge,
                "_region": region,
                "_lat": number if lat is None else lat,
                "_lon": number if lon is None else lon,
            }

    clashes = set(columns) & set(ENVELOPE)
    if clashes:
        raise ValueError(f"columns of {projection.name} hide the message envelope: {clashes}")
    # Computed in one projection, where common parts are evaluated once, then passed
    # through a one-row generator so that filters on the outcome stay above it.
    named = status | columns | extra
    prepared = decoded.select(
        *ENVELOPE, "v", "decode_error", *[c.alias(n) for n, c in m.shared[0].items()]
    )
    for level in m.shared[1:]:
        prepared = prepared.withColumns(level)
    computed = prepared.select(*ENVELOPE, *[c.alias(n) for n, c in named.items()])
    projected = computed.withColumn("outcome", quarantine.outcome()).select(
        *ENVELOPE, F.inline(F.array(F.struct(*named, "outcome")))
    )
    # Errors stop before origin derivation; only rows to be written are resolved.
    if projection.origin == "pair":
        written = F.col("outcome") == quarantine.WRITTEN
        projected = projected.withColumns(
            {
                "_subject": F.when(written, F.col("asset_id")),
                "_lat": F.when(written, F.col("_lat")),
                "_lon": F.when(written, F.col("_lon")),
            }
        )
        projected = pair_or_derive(
            projected, "_edge", "_region", Asset("_subject", "_lat", "_lon"),
            resolver.strategy, "_origin",
        )
        projected = projected.withColumns(
            {"edge_id": F.col("_origin.edge_id"), "region_id": F.col("_origin.region_id")}
        ).drop("_origin", "_edge", "_region", "_lat", "_lon", "_subject")
    return projected


def table_columns(projection: Projection, projected: DataFrame) -> list[str]:
    """Columns of the read-model table, in order."""
    hidden = {*ENVELOPE, "decode_error", "handler_error", "skipped", "write_error", "outcome",
              "provenance_fallback"}
    return [c for c in projected.columns if c not in hidden]
