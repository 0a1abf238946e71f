"""Messages of every topic, built from the given tables.

Each table row becomes one message, so building them is a narrow projection that
grows with the table. Offsets are unique and unrelated to event time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readmill.session import scratch_path
from readmill.sources.envelopes import spread

EVENT_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
# The arrival position: a scrambled id, made unique by the id itself.
SCALE = 1_000_000_000_000
HALF = 500_000 * SCALE


def arrival(row_id: Column) -> Column:
    return ((row_id * 7919) % 1000003) * F.lit(SCALE) + row_id


def micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def rfc3339(ts: Column) -> Column:
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows become messages."""
    return spread(table(spark, sf_dir, name))


PARTS = 4
#: Least number of files of each part, and rows of a part for which it has one: a micro-batch is read and decoded by about
#: as many tasks, or as many as the session has cores if files are put together.
SPLITS = 4
ROWS_PER_FILE = 20_000


def splits_of(events: DataFrame) -> int:
    return max(SPLITS, events.count() // (PARTS * ROWS_PER_FILE))


def event_stream(spark: SparkSession, sf_dir: str, redelivered: bool = False) -> DataFrame:
    """The events table as a stream of ``PARTS`` micro-batches, in the order of arrival.

    With ``redelivered`` each part but the first repeats some messages of the one before.
    """
    folder = scratch_path(spark, "event-files")
    events = table(spark, sf_dir, "events")
    splits = splits_of(events)
    part = F.expr(f"((event_id * 7919) % 1000003) * {PARTS} div 1000003")
    for k in range(PARTS):  # one after the other: the stream reads files by age
        again = (part == k - 1) & (F.col("event_id") % 6 == 1) if redelivered else F.lit(False)
        events.where((part == k) | again).repartition(splits).write.mode("append").parquet(folder)
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", splits).parquet(folder)


def message(topic: str, key: Column, body: Column, partition: Column, offset: Column) -> list[Column]:
    """Columns of a message; ``body`` is JSON text."""
    return [
        key.cast("string").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(partition, F.lit(4)).cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    ]


def event_message(df: DataFrame, topic: str, key: Column, body: Column) -> DataFrame:
    return df.select(*message(topic, key, body, F.col("user_id"), arrival(F.col("event_id"))))


def asset_key() -> Column:
    return F.concat(F.lit("asset-"), F.col("user_id"))


def unless(condition: Column, value: Column) -> Column:
    """Left out of the JSON when the condition holds."""
    return F.when(~condition, value)


# -------------------------------------------------------------------- by topic


def broken_json(events: DataFrame) -> DataFrame:
    """Every tenth truncated, every eleventh an array, some with trailing text or no value."""
    e = F.col("event_id")
    good = F.to_json(F.struct(e.alias("id"), F.col("event_type").alias("type")))
    body = (
        F.when(e % 13 == 5, F.lit(None).cast("string"))
        .when(e % 10 == 3, F.concat(F.lit("{"), good))
        .when(e % 11 == 4, F.concat(F.lit("["), good, F.lit("]")))
        .when(e % 17 == 2, F.concat(good, F.lit(" x")))
        .when(e % 19 == 7, F.concat(good, F.lit(","), good))
        .otherwise(good)
    )
    return event_message(events, "asset-cm-state", asset_key(), body)


def cloudevents(events: DataFrame) -> DataFrame:
    """Event envelopes; the severity sits under one of five keys or is missing."""
    e = F.col("event_id")
    level = F.concat(F.lit("level-"), e % 3)
    data = F.struct(
        F.col("value").alias("value"),
        F.when(e % 6 == 1, level).alias("severity"),
        F.when(e % 6 == 2, level).alias("current_status"),
        F.when(e % 6 == 3, level).alias("overall_severity"),
        F.when(e % 6 == 4, level).alias("overall_status"),
        unless(e % 4 == 1, F.concat(F.lit("edge-"), F.col("user_id") % 5)).alias("edge_id"),
        unless(e % 5 == 1, F.concat(F.lit("region-"), F.col("user_id") % 3)).alias("region_id"),
    )
    body = F.to_json(
        F.struct(
            F.concat(F.lit("evt-"), e).alias("id"),
            F.lit("/sensors").alias("source"),
            F.col("event_type").alias("type"),
            unless(e % 3 == 0, asset_key()).alias("subject"),
            unless(e % 29 == 11, rfc3339(F.col("ts"))).alias("time"),
            F.when(e % 6 == 0, F.lit("top")).alias("severity"),
            data.alias("data"),
        )
    )
    return event_message(events, "tactical-events", asset_key(), body)


def damaged_cloudevents(events: DataFrame) -> DataFrame:
    """id, source and type blanked or missing by modulus."""
    e = F.col("event_id")
    body = F.to_json(
        F.struct(
            F.when(e % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("evt-"), e)).alias("id"),
            unless(e % 5 == 0, F.lit("/sensors")).alias("source"),
            unless(e % 7 == 0, F.col("event_type")).alias("type"),
        )
    )
    return event_message(events, "tactical-events", asset_key(), body)


def cm_state(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    ns = micros(F.col("ts")) * 1000
    slots = F.transform(
        F.sequence(F.lit(1), (e % 3 + 1).cast("int")),
        lambda i: F.struct(F.concat(F.lit("slot-"), i).alias("slot_id"), e.alias("ci_id")),
    )
    body = F.to_json(
        F.struct(
            unless(e % 8 == 1, asset_key()).alias("asset_id"),
            unless(e % 3 == 1, F.concat(F.lit("edge-"), F.col("user_id") % 5)).alias("edge_id"),
            F.when(e % 4 == 1, F.lit("")).otherwise(F.lit("region-7")).alias("region_id"),
            F.concat(F.lit("base-"), e % 7).alias("baseline_id"),
            unless(e % 9 == 2, e % 4).alias("lifecycle"),
            F.when(e % 2 == 0, F.lit("CONFIG_STATUS_DEGRADED")).alias("overall_status"),
            unless(e % 5 == 2, F.when(e % 2 == 0, F.lit(4)).otherwise(F.lit(9))).alias("last_alerted_status"),
            F.when(e % 6 == 3, F.lit(0)).otherwise(ns).alias("as_of_ns"),
            F.when(e % 6 == 4, F.lit("soon")).otherwise(ns.cast("string")).alias("last_observed_at_ns"),
            unless(e % 4 == 3, slots).alias("installed"),
        )
    )
    return event_message(events, "asset-cm-state", asset_key(), body)


def logistics_status(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    factors = F.transform(
        F.sequence(F.lit(1), (e % 4 + 1).cast("int")),
        lambda i: F.struct(F.concat(F.lit("factor-"), i).alias("factor_id")),
    )
    status = F.struct(
        unless(e % 6 == 1, asset_key()).alias("asset_id"),
        F.concat(F.lit("variant-"), e % 3).alias("platform_variant"),
        unless(e % 5 == 0, F.concat(F.lit("SEVERITY_"), e % 4)).alias("overall_severity"),
        unless(e % 7 == 0, factors).alias("constraining_factors"),
        F.concat(F.col("value").cast("decimal(20,4)").cast("string"), F.lit("s")).alias(
            "projected_mission_capable_remaining"
        ),
        F.when(e % 3 == 0, F.lit("later")).otherwise(F.concat(e % 1000, F.lit("s"))).alias(
            "projected_time_to_next_constraint"
        ),
        F.concat(F.lit("base-"), e % 7).alias("cm_baseline_id"),
        F.when(e % 97 == 13, F.lit("abc"))
        .when(e % 2 == 0, (e % 1000).cast("string"))
        .otherwise(F.lit(None).cast("string"))
        .alias("status_revision"),
        rfc3339(F.col("ts")).alias("computed_at"),
        F.lit("some time ago").alias("latest_telemetry_sample_time"),
    )
    origin = F.struct(
        unless(e % 4 == 1, F.concat(F.lit("edge-"), F.col("user_id") % 5)).alias("edge_id"),
        unless(e % 4 == 2, F.lit("region-7")).alias("region_id"),
    )
    body = F.to_json(
        F.struct(
            status.alias("status"),
            F.concat(F.lit("SEVERITY_"), e % 3).alias("previous_severity"),
            unless(e % 3 == 0, e % 2 == 0).alias("is_transition"),
            F.when(e % 5 == 0, F.lit(True)).alias("is_initial"),
            unless(e % 4 == 0, origin).alias("provenance"),
        )
    )
    return event_message(events, "asset-logistics-status", asset_key(), body)


def customer_position() -> tuple[Column, Column]:
    k = F.col("c_custkey")
    lat = F.when(k % 10 != 9, ((k * 37) % 1801) / F.lit(10) - 90)
    lon = ((k * 91) % 3601) / F.lit(10) - 180
    return lat.cast("double"), lon.cast("double")


def telemetry_latest(customers: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    lat, lon = customer_position()

    def quantity(value: Column) -> Column:
        return F.when(value.isNotNull(), F.struct(F.lit("deg").alias("unit"), value.alias("value")))

    wrapped, plain = k % 3 == 0, k % 3 == 1
    position = F.struct(
        F.when(
            k % 2 == 0,
            F.struct(
                F.when(wrapped, quantity(lat)).alias("latitude"),
                F.when(wrapped, quantity(lon)).alias("longitude"),
                F.when(plain, lat).alias("lat"),
                F.when(plain, lon).alias("lon"),
            ),
        ).alias("wgs84"),
        F.when((k % 2 == 1) & ~wrapped, lat.cast("string")).alias("lat"),
        F.when((k % 2 == 1) & ~wrapped, lon.cast("string")).alias("lon"),
        F.when((k % 2 == 1) & wrapped, F.lit("north")).alias("latitude"),
        F.when((k % 2 == 1) & wrapped, lon).alias("longitude"),
    )
    state = F.struct(
        F.concat(F.lit("POWER_"), k % 3).alias("power_state"),
        F.when(k % 4 == 0, F.lit("MODE_A")).alias("functional_mode"),
        F.lit("HEALTH_OK").alias("health_state"),
        (k % 2 == 0).alias("actively_receiving"),
        F.when(k % 5 == 0, F.lit(True)).alias("actively_transmitting"),
    )
    origin = F.struct(
        F.when(k % 6 == 0, F.lit("edge-own")).alias("edge_id"),
        F.when(k % 3 == 0, F.lit("region-own")).alias("region_id"),
        F.lit("2024-01-15T12:00:00+02:00").alias("sample_time"),
    )
    body = F.to_json(
        F.struct(
            F.struct(
                F.col("c_name").alias("asset_id"),
                F.col("c_mktsegment").alias("platform_variant"),
                F.concat(F.lit("call-"), k % 100).alias("callsign"),
                F.lit("FORCE_FRIENDLY").alias("force"),
            ).alias("asset"),
            F.struct(position.alias("position")).alias("kinematics"),
            F.when(k % 7 != 0, origin).alias("provenance"),
            F.when(k % 4 != 1, (k % 50).cast("string")).alias("schema_revision"),
            F.when(k % 5 != 3, state).alias("operational_state"),
        )
    )
    return customers.select(
        *message("telemetry-latest-state", F.col("c_name"), body, k, arrival(k))
    )


def telemetry_windows(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    wear = F.transform(
        F.sequence(F.lit(1), (e % 3 + 1).cast("int")),
        lambda i: F.struct(F.concat(F.lit("part-"), i).alias("component")),
    )
    window = F.struct(
        F.when(e % 3 != 0, F.concat((e % 600).cast("string"), F.lit(".75s"))).alias("duration"),
        F.lit("60s").alias("window_duration"),
        F.when(e % 5 != 0, (e % 90).cast("string")).alias("sample_count"),
    )
    origin = F.struct(
        unless(e % 4 == 1, F.concat(F.lit("edge-"), F.col("user_id") % 5)).alias("edge_id"),
        unless(e % 4 == 2, F.lit("region-7")).alias("region_id"),
    )
    body = F.to_json(
        F.struct(
            asset_key().alias("asset_id"),
            F.concat(F.lit("variant-"), e % 3).alias("platform_variant"),
            F.create_map(F.lit("oil"), F.struct(F.col("value").alias("slope"))).alias("fluid_trends"),
            F.when(e % 2 == 0, wear).alias("wear_trends"),
            F.when(e % 7 != 0, window).alias("window"),
            rfc3339(F.col("ts")).alias("computed_at"),
            F.when(e % 6 != 0, origin).alias("provenance"),
        )
    )
    return event_message(events, "asset-telemetry-windows", asset_key(), body)


def regional_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the name of their region."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    named = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "r_regionkey", "r_name"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return customer.join(named, customer.c_nationkey == named.n_nationkey)


def fleet_summary(customers: DataFrame) -> DataFrame:
    """One summary per region: customers counted by balance bucket."""
    balance = F.col("c_acctbal")
    counts = customers.groupBy("r_name", "r_regionkey").agg(
        F.count_if(balance >= 5000).alias("nominal"),
        F.count_if((balance >= 2500) & (balance < 5000)).alias("degraded"),
        F.count_if((balance >= 0) & (balance < 2500)).alias("critical"),
        F.count_if(balance < 0).alias("non_operational"),
        F.count(F.lit(1)).alias("asset_count"),
    )
    r = F.col("r_regionkey")
    body = F.to_json(
        F.struct(
            F.when(r % 2 == 0, F.col("r_name")).alias("region_id"),
            F.col("nominal").cast("string").alias("nominal"),
            *[F.col(c) for c in ("degraded", "critical", "non_operational", "asset_count")],
            F.lit("2024-01-20").alias("observed_at"),
        )
    )
    return counts.select(*message("region-fleet-summary", F.col("r_name"), body, r, r))


def region_lists(customers: DataFrame, topic: str, name: str, entry: str) -> DataFrame:
    """One message per customer, keyed by region: a list of 0 to 3 entries, or none."""
    k = F.col("c_custkey")
    entries = F.when(
        k % 4 != 0,
        F.transform(
            F.sequence(F.lit(1), (k % 4).cast("int")),
            lambda i: F.struct(
                F.concat(F.col("c_mktsegment"), F.lit("-"), i).alias(entry), (k * i).alias("count")
            ),
        ),
    )
    body = F.to_json(
        F.struct(
            F.col("r_name").alias("region_id"),
            entries.alias(name),
            F.concat(F.lit("2024-01-20T00:00:"), F.lpad((k % 60).cast("string"), 2, "0"), F.lit("Z")).alias("observed_at"),
        )
    )
    return customers.select(*message(topic, F.col("r_name"), body, F.col("r_regionkey"), arrival(k)))


def capability_state(orders: DataFrame) -> DataFrame:
    o = F.col("o_orderkey")
    capabilities = F.transform(
        F.sequence(F.lit(1), (o % 3 + 1).cast("int")),
        lambda i: F.struct(F.concat(F.lit("store-"), i).alias("store"), (o + i).alias("rounds")),
    )
    origin = F.struct(
        F.when(o % 4 != 1, F.concat(F.lit("edge-"), F.col("o_custkey") % 5)).alias("edge_id"),
        F.when(o % 3 != 1, F.lit("region-7")).alias("region_id"),
    )
    body = F.to_json(
        F.struct(
            F.concat(F.lit("launcher-"), F.col("o_custkey")).alias("asset_id"),
            F.when(o % 5 != 2, capabilities).alias("capabilities"),
            (o % 9).cast("string").alias("schema_version"),
            F.col("o_orderstatus").alias("mode"),
            F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("T06:00:00-03:30")).alias("observed_at"),
            F.when(o % 6 != 5, origin).alias("provenance"),
        )
    )
    return orders.select(
        *message("asset-capability-snapshot", F.col("o_custkey"), body, F.col("o_custkey"), arrival(o))
    )


def line_offset() -> Column:
    return (F.col("l_partkey") * 1000003 + F.col("l_suppkey")) * 10 + F.col("l_linenumber")


def element_telemetry(lineitem: DataFrame) -> DataFrame:
    """One snapshot per line; the elements come from the line itself."""
    o, n = F.col("l_orderkey"), F.col("l_linenumber")
    elements = F.transform(
        F.sequence(F.lit(1), (n % 3 + 1).cast("int")),
        lambda i: F.struct(
            F.concat(F.lit("el-"), n, F.lit("-"), i).alias("element_id"),
            i.alias("layer_depth"),
            F.col("l_linestatus").alias("layer_name"),
            F.when(i % 2 == 0, F.lit("OK")).otherwise(F.lit("WARN")).alias("health"),
            F.col("l_quantity").cast("double").alias("temp_c"),
            F.col("l_discount").cast("double").alias("load_pct"),
            (F.col("l_suppkey") % 2 == 0).alias("tx_active"),
        ),
    )
    body = F.to_json(
        F.struct(
            F.concat(F.lit("array-"), o).alias("asset_id"),
            F.when(o % 3 != 0, F.col("l_returnflag")).alias("platform_variant"),
            F.lit("profile-a").alias("profile_name"),
            F.when(o % 4 == 0, F.lit("?")).otherwise(
                (micros(F.col("l_shipdate")) * 1000).cast("string")
            ).alias("observed_at_ns"),
            F.when(o % 5 != 0, F.struct(F.lit("ON").alias("power_state"))).alias("operational"),
            F.when(o % 7 != 0, elements).alias("elements"),
        )
    )
    return lineitem.select(
        *message("asset-element-telemetry", o, body, o, line_offset())
    )


def inventory(parts: DataFrame) -> DataFrame:
    p = F.col("p_partkey")
    size = F.col("p_size")
    available = (
        F.when(p % 5 == 0, (size + F.lit(0.7)).cast("double").cast("string"))
        .when(p % 5 == 1, F.concat(F.lit('" '), size, F.lit(' "')))
        .when(p % 5 == 2, F.concat(F.lit('"'), size, F.lit('.7"')))
        .when(p % 5 == 3, F.lit("null"))
        .otherwise(size.cast("string"))
    )
    body = F.concat(
        F.lit('{"asset_id":"  depot-'), p % 50, F.lit(' ","layer_name":"'),
        F.when(p % 11 == 0, F.lit(" ")).otherwise(F.col("p_brand")),
        F.lit('\\n","available_count":'), available,
        F.lit(',"allocated_count":'), p % 9, F.lit(',"total_count":99}'),
    )
    return parts.select(*message("asset-element-inventory", p, body, p % 50, arrival(p)))
