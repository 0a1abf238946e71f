"""One query per operator over the given tables, with deterministic columns."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readmill.functions import scalars as S
from readmill.functions import times as TM
from readmill.functions import variants as V
from readmill.operators import assignment as A
from readmill.operators import coalesce, decode, explode, merge, monitor, retention
from readmill.operators import quarantine as Q
from readmill.operators.provenance import Resolver, fieldwise, message_pair, pair_or_derive
from readmill.plans.batch import Settings, blobs_as_json, project_messages, read_model, rows_to_write
from readmill.plans.mapping import configured_projections
from readmill.plans.projections import get_projection, table_columns
from readmill.session import configure, materialise, scratch_path
from readmill.streaming import offsets
from readmill.streaming.runner import Store, maintain, run_available, table_schema
from workload import messages as M

AS_OF_MOMENT = datetime(2024, 1, 31, tzinfo=timezone.utc)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.source(configure(spark), sf_dir, "events")


def as_of() -> Column:
    return F.timestamp_micros(F.lit(int(AS_OF_MOMENT.timestamp()) * 1_000_000))


def micros(name: str) -> Column:
    return TM.epoch_micros(F.col(name)).alias(name)


def size_of(name: str, out: str) -> Column:
    return V.array_size(F.col(name)).cast("bigint").alias(out)


def at(name: str, path: str, out: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col(name), path, kind).alias(out)


def event_micros() -> Column:
    return M.micros(F.col("ts"))


# ------------------------------------------------------- decoding and quarantine


@query
def decode_json_events(spark, sf_dir):
    decoded = decode.decode_json(M.broken_json(events(spark, sf_dir)))
    return decoded.groupBy(F.coalesce("decode_error", F.lit("ok")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(V.field(F.col("v"), "id").text.cast("bigint")).alias("sum_id"),
    )


@query
def decode_cloudevents(spark, sf_dir):
    decoded = decode.decode_cloudevents(M.damaged_cloudevents(events(spark, sf_dir)))
    return decoded.groupBy(F.coalesce("decode_error", F.lit("ok")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages")
    )


def _mixed_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good, malformed, unmappable and skipped messages of one topic."""
    logistics = M.logistics_status(events(spark, sf_dir))
    row_id = F.col("offset") % F.lit(M.SCALE)
    damaged = logistics.withColumn(
        "value",
        F.when(row_id % 31 == 3, F.lit(None).cast("binary"))
        .when(row_id % 31 == 5, F.lit("not json").cast("binary"))
        .when(row_id % 31 == 7, F.lit('{"status":"down"}').cast("binary"))
        .when(row_id % 31 == 9, F.lit('{"status":{"status_revision":99999999999999999999}}').cast("binary"))
        .when(row_id % 31 == 11, F.lit('{"status":{}}').cast("binary"))
        .otherwise(F.col("value")),
    ).withColumn("key", F.when(row_id % 31 == 11, F.lit("").cast("binary"))
        .when(row_id % 31 == 13, F.unhex(F.lit("C328"))).otherwise(F.col("key")))
    return project_messages(damaged, get_projection("logistics_status"), as_of=as_of())


@query
def quarantine_summary(spark, sf_dir):
    failed = Q.quarantined(_mixed_outcomes(spark, sf_dir))
    return failed.groupBy("topic", "reason", "detail").agg(F.count(F.lit(1)).alias("messages"))


@query
def quarantine_signatures(spark, sf_dir):
    return Q.distinct_failures(Q.quarantined(_mixed_outcomes(spark, sf_dir)))


@query
def outcome_counters(spark, sf_dir):
    return monitor.outcome_counters(_mixed_outcomes(spark, sf_dir), "asset_logistics_status")


# ------------------------------------------------------------- coalesce and sinks


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "user_id", "event_id", "event_type", "value",
        event_micros().alias("event_us"),
        F.pmod(F.col("user_id"), F.lit(4)).cast("int").alias("partition"),
        M.arrival(F.col("event_id")).alias("offset"),
    )


@query
def coalesce_latest(spark, sf_dir):
    return coalesce.latest_per_key(_keyed(spark, sf_dir), ["user_id"]).select(
        "user_id", "event_id", "event_type", "value"
    )


@query
def coalesce_message_key(spark, sf_dir):
    """The strict form: a malformed last message hides the good ones before it."""
    settings = Settings(coalesce="message_key")
    messages = M.broken_json(events(spark, sf_dir)).withColumn(
        "key", F.when(F.col("partition") == 3, F.lit(None).cast("binary")).otherwise(F.col("key"))
    )
    projected = project_messages(messages, get_projection("cm_state"), settings, as_of())
    return projected.select(
        F.coalesce(F.col("key").cast("string"), F.lit("(none)")).alias("message_key"),
        "outcome",
        (F.col("offset") % F.lit(M.SCALE)).alias("event_id"),
    )


@query
def upsert_two_batches(spark, sf_dir):
    """Two batches merged into a target that also has a column of its own."""
    keyed = _keyed(spark, sf_dir)
    first = coalesce.latest_per_key(keyed.filter(F.col("offset") < F.lit(M.HALF)), ["user_id"])
    second = coalesce.latest_per_key(keyed.filter(F.col("offset") >= F.lit(M.HALF)), ["user_id"])
    target = first.withColumn("owner_note", F.concat(F.lit("note-"), "user_id"))
    return merge.upsert(target, second, ["user_id"]).select(
        "user_id", "event_id", "event_type", "value", "owner_note"
    )


@query
def upsert_composite_key(spark, sf_dir):
    keyed = _keyed(spark, sf_dir)
    keys = ["user_id", "event_type"]
    first = coalesce.latest_per_key(keyed.filter(F.col("offset") < F.lit(M.HALF)), keys)
    second = coalesce.latest_per_key(keyed.filter(F.col("offset") >= F.lit(M.HALF)), keys)
    return merge.upsert(first, second, keys).select(*keys, "event_id", "value")


@query
def append_ignore(spark, sf_dir):
    """A redelivered copy with another value changes nothing; new ids are added."""
    keyed = _keyed(spark, sf_dir).withColumn("id", F.col("event_id"))
    target = keyed.filter(F.col("event_id") % 3 != 0)
    copies = keyed.withColumn("value", F.col("value") + 1000).union(
        keyed.withColumns({"value": F.col("value") + 2000, "offset": F.col("offset") + F.lit(M.SCALE // 2)})
    )
    batch = coalesce.earliest_per_key(copies, ["id"])
    added = merge.append_new(target, batch, ["id"])
    return target.unionByName(added).select("id", "user_id", "value")


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 50 != 7, F.timestamp_micros(event_micros())).alias("time"),
    )


@query
def prune_retention(spark, sf_dir):
    kept = retention.prune(_timed(spark, sf_dir), "time", 240, as_of())
    return kept.select("event_id", micros("time"))


@query
def prune_counts(spark, sf_dir):
    return retention.pruned_counts(_timed(spark, sf_dir), "time", 240, as_of())


@query
def prune_ttl_policy(spark, sf_dir):
    """The TTL rule over one settings row per customer."""
    c = F.col("c_custkey")
    settings = M.table(configure(spark), sf_dir, "customer").select(
        c.alias("setting_id"),
        F.when(c % 3 == 0, F.lit("append")).otherwise(F.lit("upsert")).alias("mode"),
        F.when(c % 2 == 0, F.lit(24)).alias("retention_hours"),
        F.when(c % 5 == 0, F.lit(0)).when(c % 5 < 4, F.lit(24)).alias("asset_ttl_hours"),
        F.when(c % 7 == 1, F.lit(6)).when(c % 7 == 2, F.lit(0)).alias("override_hours"),
    )
    hours = retention.effective_hours(
        F.col("mode"), F.col("retention_hours"), F.col("asset_ttl_hours"), F.col("override_hours")
    )
    return settings.select("setting_id", "mode", hours.cast("bigint").alias("hours"))


# ------------------------------------------------------------------- projections


def _model(messages: DataFrame, name: str, settings: Settings = Settings(), only: tuple[str, ...] | None = None) -> DataFrame:
    return read_model(messages, get_projection(name), settings, as_of(), only)


@query
def proj_cm_state(spark, sf_dir):
    return _cm_columns(_model(M.cm_state(events(spark, sf_dir)), "cm_state"))


#: The configuration-management table as a deployment would describe it.
CONFIGURED = {
    "name": "configured_state", "topic": "asset-cm-state", "table": "configured_state",
    "key": {"column": "asset_id", "path": "asset_id"},
    "fields": {
        "baseline_id": "baseline_id",
        "lifecycle": {
            "path": "lifecycle", "rule": "enum", "names": {"2": "LIFECYCLE_ACTIVE"}, "default": "LIFECYCLE_UNSPECIFIED",
        },
        "overall_status": {"path": "overall_status", "rule": "enum", "default": "CONFIG_STATUS_UNSPECIFIED"},
        "last_alerted_status": {
            "path": "last_alerted_status", "rule": "enum", "names": {4: "CONFIG_STATUS_NOT_MISSION_CAPABLE"},
        },
        "as_of": {"path": "as_of_ns", "rule": "ns_instant"},
        "last_observed_at": {"path": "last_observed_at_ns", "rule": "ns_instant"},
        "installed": {"path": "installed", "rule": "list"},
        "mod_status": {"path": "mod_status", "rule": "list"},
        "discrepancies": {"path": "discrepancies", "rule": "list"},
    },
    "origin": {"kind": "fieldwise"},
    "asset_ttl_hours": 24,
}


def _cm_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "asset_id", "edge_id", "region_id", "baseline_id", "lifecycle", "overall_status",
        "last_alerted_status", micros("as_of"), micros("last_observed_at"),
        size_of("installed", "n_installed"), at("installed", "$[0].slot_id", "first_slot"),
        size_of("mod_status", "n_mods"), size_of("discrepancies", "n_discrepancies"),
        micros("updated_at"),
    )


@query
def proj_configured_fields(spark, sf_dir):
    """A projection made of configured paths and rules alone."""
    projection = configured_projections([CONFIGURED])["configured_state"]
    return _cm_columns(read_model(M.cm_state(events(spark, sf_dir)), projection, Settings(), as_of()))


@query
def proj_configured_handler(spark, sf_dir):
    """A known projection under another name and table: its key still lies inside the message."""
    configure(spark)
    entry = {"name": "fleet", "handler": "logistics_status", "topic": "fleet-status", "table": "fleet_state"}
    projection = configured_projections([entry])["fleet"]
    messages = M.logistics_status(events(spark, sf_dir)).withColumn("key", F.lit("other").cast("binary"))
    rows = read_model(messages, projection, Settings(), as_of())
    return rows.select("asset_id", "status_revision", micros("updated_at"))


@query
def proj_logistics_status(spark, sf_dir):
    rows = _model(M.logistics_status(events(spark, sf_dir)), "logistics_status")
    return rows.select(
        "asset_id", "edge_id", "region_id", "platform_variant", "overall_severity",
        "previous_severity", size_of("constraining_factors", "n_factors"),
        "projected_mission_capable_remaining_seconds",
        "projected_time_to_next_constraint_seconds", "cm_baseline_id", "status_revision",
        micros("computed_at"), micros("latest_telemetry_sample_time"),
        "is_transition", "is_initial", micros("updated_at"),
    )


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return M.table(spark, sf_dir, "supplier").select(
        s.alias("ordinal"),
        F.concat(F.lit("edge-"), s).alias("edge_id"),
        F.concat(F.lit("region-"), s % 5).alias("region_id"),
        (((s * 53) % 1201) * F.lit(0.137) - 82.3).alias("lat"),
        (((s * 71) % 2503) * F.lit(0.1393) - 174.7).alias("lon"),
        F.col("s_name").alias("label"),
    )


@query
def proj_telemetry_latest(spark, sf_dir):
    configure(spark)
    near = A.with_fallback(A.nearest_site_table(_sites(spark, sf_dir)))
    messages = M.telemetry_latest(M.source(spark, sf_dir, "customer"))
    rows = _model(messages, "telemetry_latest", Settings(resolver=Resolver(near)))
    return rows.select(
        "asset_id", "edge_id", "region_id", "platform_variant", "callsign", "force_id",
        at("provenance", "$.edge_id", "stamped_edge"), micros("last_sample_at"),
        "schema_revision", "power_state", "functional_mode", "health_state",
        "actively_receiving", "actively_transmitting",
        F.col("sustainment").isNull().alias("no_sustainment"), micros("updated_at"),
    )


@query
def proj_tactical_events(spark, sf_dir):
    rows = _model(M.cloudevents(events(spark, sf_dir)), "tactical_events")
    return rows.select(
        "id", "edge_id", "region_id", "source", "type", "subject", "severity", micros("time"),
        at("data", "$.value", "data_value", "double"), micros("ingested_at"),
    )


@query
def proj_telemetry_windows(spark, sf_dir):
    rows = _model(M.telemetry_windows(events(spark, sf_dir)), "telemetry_windows")
    return rows.select(
        "asset_id", "edge_id", "region_id", "platform_variant",
        at("fluid_trends", "$.oil.slope", "oil_slope", "double"),
        size_of("consumable_trends", "n_consumable"),
        size_of("component_wear_trends", "n_wear"),
        "window_duration_seconds", "sample_count", micros("computed_at"), micros("updated_at"),
    )


@query
def proj_region_fleet_summary(spark, sf_dir):
    configure(spark)
    rows = _model(M.fleet_summary(M.regional_customers(spark, sf_dir)), "region_fleet_summary")
    return rows.select(
        "region_id", "nominal", "degraded", "critical", "non_operational", "asset_count",
        micros("observed_at"), micros("updated_at"),
    )


@query
def proj_region_top_factors(spark, sf_dir):
    configure(spark)
    messages = M.region_lists(
        M.regional_customers(spark, sf_dir), "region-top-factors", "factors", "factor_id"
    )
    return _model(messages, "region_top_factors").select(
        "region_id", size_of("factors", "n_factors"), at("factors", "$[0].factor_id", "first_factor"),
        at("factors", "$[0].count", "first_count", "bigint"),
        micros("observed_at"), micros("updated_at"),
    )


@query
def proj_region_wear_trends(spark, sf_dir):
    configure(spark)
    messages = M.region_lists(
        M.regional_customers(spark, sf_dir), "region-wear-trends", "components", "component_id"
    )
    return _model(messages, "region_wear_trends").select(
        "region_id", size_of("components", "n_components"),
        at("components", "$[0].component_id", "first_component"),
        micros("observed_at"), micros("updated_at"),
    )


def _prefix_resolver() -> Resolver:
    prefixes = {"launcher-1": ("edge-one", "region-one"), "launcher-12": ("edge-twelve", "region-one")}
    return Resolver(A.with_fallback(A.longest_prefix(prefixes)))


@query
def proj_capability_state(spark, sf_dir):
    orders = M.source(configure(spark), sf_dir, "orders")
    rows = _model(M.capability_state(orders), "capability_state", Settings(resolver=_prefix_resolver()))
    return rows.select(
        "asset_id", size_of("capabilities", "n_capabilities"),
        at("capabilities", "$[0].rounds", "first_rounds", "bigint"), "schema_version", "mode",
        micros("observed_at"), micros("updated_at"), "edge_id", "region_id",
    )


@query
def explode_capabilities(spark, sf_dir):
    orders = M.source(configure(spark), sf_dir, "orders")
    rows = _model(M.capability_state(orders), "capability_state", only=("capabilities",))
    return explode.explode_capabilities(rows).select(
        "asset_id", F.col("position").cast("bigint").alias("position"),
        at("capability", "$.store", "store"), at("capability", "$.rounds", "rounds", "bigint"),
    )


@query
def proj_element_telemetry(spark, sf_dir):
    lines = M.source(configure(spark), sf_dir, "lineitem")
    rows = _model(M.element_telemetry(lines), "asset_element_telemetry")
    return rows.select(
        "asset_id", "platform_variant", "profile_name", size_of("elements", "n_elements"),
        at("elements", "$[0].element_id", "first_element"),
        at("operational", "$.power_state", "power_state"),
        micros("observed_at"), micros("updated_at"), "edge_id", "region_id",
    )


@query
def explode_elements(spark, sf_dir):
    lines = M.source(configure(spark), sf_dir, "lineitem")
    rows = _model(M.element_telemetry(lines), "asset_element_telemetry", only=("elements",))
    return explode.explode_elements(rows).withColumn("position", F.col("position").cast("bigint"))


@query
def proj_inventory(spark, sf_dir):
    parts = M.source(configure(spark), sf_dir, "part")
    rows = _model(M.inventory(parts), "asset_element_inventory")
    return rows.select(
        "id", "name", "asset_id", "layer_name", "available_count", "allocated_count",
        micros("updated_at"),
    )


# ------------------------------------------------------------------------- joins


def _assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = M.customer_position()
    return M.table(configure(spark), sf_dir, "customer").select(
        F.col("c_name").alias("asset_id"), lat.alias("lat"), lon.alias("lon"), "c_custkey"
    )


def _assigned(df: DataFrame) -> DataFrame:
    return df.select(
        "asset_id", F.col("a.edge_id").alias("edge_id"), F.col("a.region_id").alias("region_id"),
        F.col("a.basis.method").alias("method"), F.col("a.basis.fob_label").alias("fob_label"),
        F.col("a.basis.distance_km").alias("distance_km"), F.col("a.basis.prefix").alias("prefix"),
    )


@query
def join_nearest_site(spark, sf_dir):
    """Chooses literals or tiles by the size of the site table."""
    near = A.nearest_site_table(_sites(spark, sf_dir))
    return _assigned(near(_assets(spark, sf_dir), A.Asset(), "a"))


@query
def join_nearest_site_blocked(spark, sf_dir):
    near = A.nearest_site_table(_sites(spark, sf_dir), small=0)
    return _assigned(near(_assets(spark, sf_dir), A.Asset(), "a"))


@query
def great_circle(spark, sf_dir):
    """Distance of every customer to a fixed point, rounded to metres."""
    from readmill.functions.geo import great_circle_km

    km = great_circle_km(F.col("lat"), F.col("lon"), F.lit(35.25), F.lit(-97.5))
    return _assets(spark, sf_dir).select("asset_id", F.round(km, 3).alias("km"))


PREFIXES = {
    "": ("edge-any", "region-any"),
    "Customer#0000000": ("edge-a", "region-a"),
    "Customer#00000001": ("edge-b", "region-b"),
    "Customer#000000012": ("edge-c", "region-c"),
}


def _prefix_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier number, cut to three lengths, as a customer prefix."""
    s = F.col("s_suppkey")
    name = F.concat(F.lit("Customer#"), F.lpad((s * 7).cast("string"), 9, "0"))
    cut = F.when(s % 3 == 0, F.substring(name, 1, 15)).when(
        s % 3 == 1, F.substring(name, 1, 17)
    ).otherwise(name)
    base = M.table(spark, sf_dir, "supplier").select(cut.alias("prefix"))
    return base.distinct().select(
        "prefix",
        F.concat(F.lit("edge-"), F.col("prefix")).alias("edge_id"),
        F.concat(F.lit("region-"), F.length("prefix")).alias("region_id"),
    )


@query
def join_longest_prefix(spark, sf_dir):
    """Configured prefixes, as literals."""
    return _assigned(A.longest_prefix(PREFIXES)(_assets(spark, sf_dir), A.Asset(), "a"))


@query
def join_longest_prefix_table(spark, sf_dir):
    """A table of prefixes: one equi-join per prefix length."""
    strategy = A.longest_prefix_table(_prefix_table(configure(spark), sf_dir))
    return _assigned(strategy(_assets(spark, sf_dir), A.Asset(), "a"))


@query
def join_longest_prefix_blocked(spark, sf_dir):
    """The shuffled form for prefix tables too large to broadcast."""
    strategy = A.longest_prefix_table(_prefix_table(configure(spark), sf_dir), broadcast_rows=0)
    return _assigned(strategy(_assets(spark, sf_dir), A.Asset(), "a"))


def _static(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return M.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("Customer#"), F.lpad((s * 11).cast("string"), 9, "0")).alias("asset_id"),
        F.concat(F.lit("edge-"), s).alias("edge_id"),
        F.concat(F.lit("region-"), s % 5).alias("region_id"),
    )


@query
def join_static(spark, sf_dir):
    strategy = A.static_table(_static(configure(spark), sf_dir))
    return _assigned(strategy(_assets(spark, sf_dir), A.Asset(), "a"))


CHAIN_CONFIG = {
    "strategy": "chain",
    "chain": [
        {
            "strategy": "static",
            "static_map": {"Customer#000000003": {"edge_id": "edge-s", "region_id": "region-s"}},
        },
        {
            "strategy": "chain",
            "chain": [
                {
                    "strategy": "asset_id_prefix",
                    "asset_id_prefix_map": {
                        "Customer#00000000": {"edge_id": "edge-p", "region_id": "region-p"},
                        "Customer#000000007": {"edge_id": "edge-q", "region_id": "region-q"},
                    },
                },
                {
                    "strategy": "nearest_fob",
                    "fobs": [
                        {"edge_id": "f1", "region_id": "r1", "lat": 47.25, "lon": -12.5, "label": "north"},
                        {"edge_id": "f2", "region_id": "r2", "lat": 5.75, "lon": 118.5, "label": "east"},
                        {"edge_id": "f3", "region_id": "r3", "lat": -36.5, "lon": 61.25},
                    ],
                },
            ],
        },
    ],
    "fallback": {"edge_id": "edge-last", "region_id": "region-last"},
}


@query
def join_static_config(spark, sf_dir):
    """A configured map of 400 entries, more than literals take."""
    configure(spark)
    block = {
        f"Customer#{n * 3:09d}": {"edge_id": f"edge-{n}", "region_id": f"region-{n % 5}"} for n in range(400)
    }
    strategy = A.configured({"strategy": "static", "static_map": block})
    return _assigned(strategy(_assets(spark, sf_dir), A.Asset(), "a"))


@query
def join_chain_tables(spark, sf_dir):
    """A static table, then a prefix table in its shuffled form."""
    prefixes = A.longest_prefix_table(_prefix_table(configure(spark), sf_dir), broadcast_rows=0)
    strategy = A.chain(A.static_table(_static(spark, sf_dir)), prefixes)
    return _assigned(strategy(_assets(spark, sf_dir), A.Asset(), "a"))


@query
def join_chain_fallback(spark, sf_dir):
    """A configured chain: static, then prefix, then nearest of three, then fallback."""
    strategy = A.configured_resolver(CHAIN_CONFIG)
    return _assigned(strategy(_assets(spark, sf_dir), A.Asset(), "a"))


def _origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    origin = F.struct(
        F.when(e % 4 == 0, F.lit("")).when(e % 4 != 1, F.concat(F.lit("edge-"), F.col("user_id") % 5)).alias("edge_id"),
        F.when(e % 3 == 0, F.lit("")).when(e % 3 != 1, F.lit("region-7")).alias("region_id"),
    )
    block = F.parse_json(F.to_json(origin))
    edge, region = message_pair(V.field(block))
    return events(spark, sf_dir).select(
        "event_id", F.concat(F.lit("asset-"), "user_id").alias("asset_id"),
        edge.alias("edge"), region.alias("region"),
    )


@query
def provenance_fieldwise(spark, sf_dir):
    edge, region, missing = fieldwise(F.col("edge"), F.col("region"))
    return _origins(spark, sf_dir).select(
        "event_id", edge.alias("edge_id"), region.alias("region_id"), missing.alias("fallback")
    )


@query
def provenance_pair(spark, sf_dir):
    number = F.lit(None).cast("double")
    assets = _origins(spark, sf_dir).withColumns({"lat": number, "lon": number})
    strategy = A.with_fallback(A.longest_prefix({"asset-1": ("edge-one", "region-one")}))
    found = pair_or_derive(assets, "edge", "region", A.Asset(), strategy, "origin")
    return found.select("event_id", "origin.edge_id", "origin.region_id")


@query
def enum_names(spark, sf_dir):
    """Numbers, texts, unknown numbers and missing values of one enum."""
    e = F.col("event_id")
    raw = F.when(e % 5 == 0, F.lit('"NAMED"')).when(e % 5 == 1, F.lit("null")).otherwise(
        (e % 4).cast("string")
    )
    f = F.parse_json(raw)
    name = S.enum_name(V.field(f), {1: "ONE", 2: "TWO"}, "NONE")
    return events(spark, sf_dir).select("event_id", name.alias("name"))


@query
def scalar_times(spark, sf_dir):
    """Instants, nanoseconds and durations parsed back from their wire text."""
    e = F.col("event_id")
    text = (
        F.when(e % 6 == 0, M.rfc3339(F.col("ts")))
        .when(e % 6 == 1, F.substring(M.rfc3339(F.col("ts")), 1, 10))
        .when(e % 6 == 2, F.concat(F.substring(M.rfc3339(F.col("ts")), 1, 19), F.lit("+05:30")))
        .when(e % 6 == 3, F.substring(M.rfc3339(F.col("ts")), 1, 7))
        .when(e % 6 == 4, F.substring(M.rfc3339(F.col("ts")), 1, 19))
    )
    ns = F.parse_json((event_micros() * 1000 * F.when(e % 5 == 0, -1).otherwise(1)).cast("string"))
    duration = F.parse_json(F.concat(F.lit('"'), (e % 7200).cast("string"), F.lit('.5s"')))
    return events(spark, sf_dir).select(
        "event_id",
        TM.epoch_micros(TM.instant(text)).alias("instant_us"),
        TM.epoch_micros(TM.ns_instant(V.field(ns))).alias("ns_us"),
        TM.epoch_micros(TM.ns_instant_or(V.field(ns), as_of())).alias("ns_any_us"),
        TM.duration_seconds(V.field(duration)).alias("seconds"),
    )


@query
def first_present(spark, sf_dir):
    """The first of three entries that is there and not null; 0 and the empty text count as there."""
    e = F.col("event_id")
    body = F.concat(
        F.when(e % 3 == 0, '{"a":null,').when(e % 3 == 1, '{"a":0,').otherwise("{"),
        F.when(e % 2 == 0, '"b":"",').otherwise(""), F.lit('"c":"c-'), e, F.lit('"}'),
    )
    read = events(spark, sf_dir).select("event_id", F.parse_json(body).alias("v"))
    found = V.first_present(*(V.field(F.col("v"), name) for name in "abc"))
    return read.select("event_id", F.try_variant_get(found, "$", "string").alias("found"))


@query
def blobs_as_text(spark, sf_dir):
    """Nested columns as JSON text, as for a sink without such a type; what the message has not got stays NULL."""
    made = _model(M.telemetry_latest(M.source(configure(spark), sf_dir, "customer")), "telemetry_latest")
    rows = blobs_as_json(made, get_projection("telemetry_latest").variants)
    slots = blobs_as_json(_model(M.cm_state(events(spark, sf_dir)), "cm_state"), ("installed",))
    return slots.select("asset_id", F.col("installed").alias("blob")).unionByName(
        rows.select("asset_id", F.when(F.col("sustainment").isNotNull(), "some").alias("blob"))
    )


@query
def link_state(spark, sf_dir):
    """Link severed flag over one proxy row per event."""
    e = F.col("event_id")
    enabled = F.when(e % 3 == 0, F.lit(False)).when(e % 3 == 1, F.lit(True))
    toxics = F.when(e % 4 == 0, F.array("event_type")).when(e % 4 == 1, F.array().cast("array<string>"))
    return events(spark, sf_dir).select("event_id", S.link_severed(enabled, toxics).alias("severed"))


# -------------------------------------------------------------------- monitoring


def _offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    partition = F.pmod(F.col("user_id"), F.lit(4))
    return (
        events(spark, sf_dir)
        .groupBy(F.col("event_type").alias("topic"), partition.cast("int").alias("partition"))
        .agg(
            F.min("event_id").alias("lo"),
            (F.max("event_id") + 1).alias("hi"),
            F.count(F.lit(1)).alias("n"),
        )
        .select(
            F.lit("bridge").alias("group"), "topic", "partition", "lo", "hi",
            F.when(F.col("partition") == 3, F.lit(-1001)).otherwise(F.col("lo") + F.col("n")).alias("committed"),
        )
    )


@query
def consumer_lag(spark, sf_dir):
    return monitor.consumer_lag(_offsets(spark, sf_dir))


@query
def edge_buffer_status(spark, sf_dir):
    """A reading, a group without commits, and a missing link row."""
    offsets = _offsets(spark, sf_dir)
    links = events(spark, sf_dir).groupBy(F.col("event_type").alias("proxy")).agg(
        (F.count(F.lit(1)) > 0).alias("enabled")
    ).withColumn("toxics", F.array().cast("array<string>"))
    cases = [("bridge", "click", "case-1"), ("absent", "click", "case-2"), ("bridge", "gone", "case-3")]
    status = None
    for group, proxy, name in cases:
        one = monitor.edge_buffer_status(
            offsets, links, group, proxy, as_of(), topics=("click", "error")
        ).select(
            F.lit(name).alias("case_name"), "id", "bridge_group_lag", "hq_link_severed",
            "probe_healthy", micros("updated_at"),
        )
        status = one if status is None else status.unionByName(one)
    return status


@query
def fallback_throttle(spark, sf_dir):
    seconds = F.floor(event_micros() / F.lit(1000000)).cast("bigint").alias("second")
    seen = events(spark, sf_dir).select("event_type", "user_id", seconds)
    return monitor.fallback_report(seen, ["event_type", "user_id"], "second", 6 * 3600)


@query
def projected_fallbacks(spark, sf_dir):
    """Site-default fallbacks of the event log, throttled per subject; without a time they count at ``as_of``."""
    projected = project_messages(
        M.cloudevents(events(spark, sf_dir)), get_projection("tactical_events"), as_of=as_of()
    )
    fallbacks = projected.filter("outcome = 'written' and provenance_fallback")
    seen = fallbacks.select("topic", "subject", F.unix_seconds(F.coalesce("time", as_of())).alias("second"))
    return monitor.fallback_report(seen, ["topic", "subject"], "second", 24 * 3600)


# --------------------------------------------------------------------- streaming


def _streamed(
    spark: SparkSession, sf_dir: str, name: str, build, redelivered: bool = False
) -> tuple[Store, DataFrame]:
    """Run one projection over the events table as a stream and read its table."""
    configure(spark)
    store = Store(spark, scratch_path(spark, name))
    projection = get_projection(name)
    run_available(projection, build(M.event_stream(spark, sf_dir, redelivered)), store, as_of=as_of())
    return store, store.table(projection, table_schema(spark, projection)).read()


@query
def stream_append_ignore(spark, sf_dir):
    _, rows = _streamed(spark, sf_dir, "tactical_events", M.cloudevents, redelivered=True)
    kept = retention.prune(rows, "time", 240, as_of())
    return kept.select("id", "edge_id", "region_id", "subject", "severity", micros("time"))


@query
def stream_upsert(spark, sf_dir):
    _, rows = _streamed(spark, sf_dir, "telemetry_windows", M.telemetry_windows)
    return rows.select(
        "asset_id", "edge_id", "region_id", "platform_variant", "window_duration_seconds",
        "sample_count", micros("computed_at"),
    )


@query
def stream_metrics(spark, sf_dir):
    store, _ = _streamed(spark, sf_dir, "logistics_status", M.logistics_status)
    counters = spark.read.parquet(store.metrics_path())
    return counters.groupBy("metric", "label").agg(F.sum("value").alias("value"))


def _arrival_clock() -> Column:
    """A second for every message that rises with its arrival."""
    return F.timestamp_seconds(F.expr(f"offset div {M.SCALE}"))


@query
def stream_fallbacks(spark, sf_dir):
    """Reports that a stream writes beside its table, throttled over four micro-batches; old counts are forgotten."""
    configure(spark)
    store, projection = Store(spark, scratch_path(spark, "fallbacks")), get_projection("cm_state")
    settings = Settings(fallback_window_s=6 * 3600, fallback_keep_s=24 * 3600)
    run_available(projection, M.cm_state(M.event_stream(spark, sf_dir)), store, settings, as_of=_arrival_clock())
    return store.fallbacks(projection, settings).read()


@query
def stream_lag(spark, sf_dir):
    """How far a stream has come that got the first half of three partitions, against all messages."""
    configure(spark)
    store, projection = Store(spark, scratch_path(spark, "lag")), get_projection("cm_state")
    seen = (F.col("offset") < F.lit(M.HALF)) & (F.col("partition") < 3)
    run_available(projection, M.cm_state(M.event_stream(spark, sf_dir)).where(seen), store, as_of=as_of())
    ends = offsets.ends_of(M.cm_state(events(spark, sf_dir)))
    read = offsets.stream_offsets(ends, store.consumed(), "projector")
    total = monitor.consumer_lag(read).withColumnRenamed("lag", "topic_lag")
    return read.join(total, "topic").select("topic", "partition", "committed", monitor.partition_lag().alias("lag"), "topic_lag")


@query
def changelog_compaction(spark, sf_dir):
    """Two batches, the first merged with a TTL, a replay, a vacuum."""
    configure(spark)
    projection = get_projection("cm_state")
    schema = table_schema(spark, projection)
    table = Store(spark, scratch_path(spark, "changelog")).table(projection, schema)
    messages = M.cm_state(events(spark, sf_dir))
    halves = (F.col("offset") < F.lit(M.HALF), F.col("offset") >= F.lit(M.HALF))
    for batch_id, half in enumerate(halves):
        projected = project_messages(messages.filter(half), projection, as_of=as_of())
        table.write_batch(rows_to_write(projected, projection), batch_id)
    table.merge(0, AS_OF_MOMENT, 24)
    replayed = project_messages(messages.filter(halves[0]), projection, as_of=as_of())
    table.write_batch(rows_to_write(replayed, projection), 0)
    table.vacuum(grace_s=0)
    return table.read().select(
        "asset_id", "edge_id", "region_id", "baseline_id", "lifecycle", "overall_status", micros("as_of")
    )


def _aged(spark: SparkSession, sf_dir: str) -> tuple[Store, DataFrame]:
    """A table of which every third user's rows are three days old, after one run of upkeep."""
    configure(spark)
    projection = get_projection("cm_state")
    store = Store(spark, scratch_path(spark, "aged"))
    table = store.table(projection, table_schema(spark, projection))
    old = F.col("user_id") % 3 == 0
    moments = (as_of() - F.expr("INTERVAL 3 DAYS"), as_of())
    for batch_id, (own, moment) in enumerate(zip((old, ~old), moments)):
        messages = M.cm_state(events(spark, sf_dir).where(own))
        projected = project_messages(messages, projection, as_of=moment)
        table.write_batch(rows_to_write(projected, projection), batch_id)
    table.compact()
    return store, maintain(store, [projection], AS_OF_MOMENT)


@query
def maintain_tables(spark, sf_dir):
    """What is left of an idle table when its old rows are pruned."""
    projection = get_projection("cm_state")
    store, _ = _aged(spark, sf_dir)
    rows = store.table(projection, table_schema(spark, projection)).read()
    return rows.select("asset_id", "baseline_id", micros("updated_at"))


@query
def pruned_rows(spark, sf_dir):
    """The pruned-rows counter, as the metrics hold it."""
    store, _ = _aged(spark, sf_dir)
    return spark.read.parquet(store.metrics_path()).select("metric", "label", "value")


@query
def upkeep_beside_stream(spark, sf_dir):
    """A batch that upkeep pruned before its stream noted it as done, delivered again."""
    configure(spark)
    projection = get_projection("cm_state")
    store = Store(spark, scratch_path(spark, "beside"))
    table = store.table(projection, table_schema(spark, projection))
    old = F.col("user_id") % 3 == 0
    past = as_of() - F.expr("INTERVAL 3 DAYS")
    for batch_id, own, moment in ((0, ~old, as_of()), (1, old, past), (1, old, as_of())):
        projected = project_messages(M.cm_state(events(spark, sf_dir).where(own)), projection, as_of=moment)
        table.write_batch(rows_to_write(projected, projection), batch_id)
        if moment is past:
            maintain(store, [projection], AS_OF_MOMENT)
    return table.read().select("asset_id", "baseline_id", micros("updated_at"))


@query
def leveled_runs(spark, sf_dir):
    """A table after many batches: its rows, and the runs of the bucket that has most."""
    configure(spark)
    projection = get_projection("cm_state")
    table = Store(spark, scratch_path(spark, "runs")).table(projection, table_schema(spark, projection))
    projected = project_messages(M.cm_state(events(spark, sf_dir)), projection, as_of=as_of())
    wanted = [*table_columns(projection, projected), "partition", "offset", "outcome"]
    rows = materialise(projected.select(*dict.fromkeys(wanted)).withColumn("slice", F.expr(f"offset * 8 div {2 * M.HALF}")), "slices")
    for batch_id in range(8):
        table.write_batch(rows_to_write(rows.where(F.col("slice") == batch_id).drop("slice"), projection), batch_id)
    table.compact()
    runs = [r.bucket for r in table.runs()]
    most = max(map(runs.count, runs))
    # A bucket's runs at least double in length.
    bound = table.read().count().bit_length() + 1
    return table.read().select("asset_id", "baseline_id", micros("as_of"), F.lit(most <= bound).alias("few_runs"))


@query
def event_log_upkeep(spark, sf_dir):
    """An event log of three batches, each repeating events of the one before, pruned to the row; ``pruned`` rows went."""
    configure(spark)
    projection = get_projection("tactical_events")
    log = Store(spark, scratch_path(spark, "events")).table(projection, table_schema(spark, projection))
    source = events(spark, sf_dir)
    part = F.col("event_id") % 3
    for batch_id in range(3):
        again = (part == batch_id - 1) & (F.col("event_id") % 7 == 2)
        messages = M.cloudevents(source.where((part == batch_id) | again))
        projected = project_messages(messages, projection, as_of=as_of())
        log.write_batch(materialise(rows_to_write(projected, projection), "event-batch"), batch_id)
    gone = log.prune(AS_OF_MOMENT, 240)
    log.vacuum(grace_s=0)
    kept = log.read()
    return kept.select("id", "edge_id", "region_id", "subject", "severity", micros("time"), F.lit(gone).cast("bigint").alias("pruned"))


# ---------------------------------------------------------------------- flagship


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as envelopes -> decoded -> projected -> appended once -> pruned."""
    log = _model(M.cloudevents(events(spark, sf_dir)), "tactical_events")
    kept = retention.prune(log, "time", 240, as_of())
    return kept.select(
        "id", "edge_id", "region_id", "source", "type", "subject", "severity", micros("time")
    )


@query
def event_log_slice(spark, sf_dir):
    return flagship(spark, sf_dir)
