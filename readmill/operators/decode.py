"""Message bytes -> VARIANT plus a reason when a message cannot be decoded.

Every decoder adds two columns: ``v`` (the decoded object) and ``decode_error``
(NULL when good). No message is dropped here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readmill.functions import variants as V

Decoder = Callable[[DataFrame], DataFrame]

# Attributes every event envelope must carry, in reporting order.
REQUIRED_ATTRIBUTES = ("id", "source", "type")

# Message types with a projection.
PROTO_MESSAGES = (
    "AsMaintainedConfiguration",
    "AssetLogisticsStatusUpdate",
    "EntityTelemetryEvent",
    "WindowedTelemetry",
    "RegionFleetSummary",
    "RegionTopFactors",
    "RegionWearTrends",
)

_TOMBSTONE = "message without a value"
_NOT_JSON = "value is not JSON text"


def decode_json(messages: DataFrame) -> DataFrame:
    """Whole-text JSON objects only."""
    return _decode_object(messages, "JSON value is a ")


def decode_cloudevents(messages: DataFrame) -> DataFrame:
    """JSON objects with a truthy id, source and type."""
    decoded = _decode_object(messages, "CloudEvent envelope is ")
    texts = {a: F.try_variant_get(F.col("v"), f"$.{a}", "string") for a in REQUIRED_ATTRIBUTES}
    read = decoded.withColumns({f"_{a}": text for a, text in texts.items()})

    def shared(attribute: str) -> V.Field:
        return V.Field(F.col("v"), f".{attribute}", lambda _, __: F.col(f"_{attribute}"))

    missing = F.concat_ws(
        ", ", *[F.when(~V.truthy(shared(a)), F.lit(a)) for a in REQUIRED_ATTRIBUTES]
    )
    listed = read.withColumn("_missing", F.when(F.col("v").isNotNull(), missing))
    error = F.when(
        F.col("_missing") != "",
        F.concat(F.lit("CloudEvent missing required attribute(s): "), F.col("_missing")),
    )
    good = F.when(F.col("_missing") == "", F.col("v"))
    checked = _once(listed, good, F.coalesce(F.col("decode_error"), error))
    return checked.drop("_missing", *[f"_{a}" for a in REQUIRED_ATTRIBUTES])


def _once(df: DataFrame, v: Column, error: Column) -> DataFrame:
    """Add ``v`` and ``decode_error`` through a one-row generator.

    Filters on what is derived from them then stay above the parse. Without this the
    optimizer copies the parse into the filter, once for every field it reads.
    """
    pair = F.struct(v.alias("v"), error.alias("decode_error"))
    rest = [c for c in df.columns if c not in ("v", "decode_error")]
    return df.select(*rest, F.inline(F.array(pair)))


def _decode_object(messages: DataFrame, type_error: str) -> DataFrame:
    """One parse per message.

    JSON parsing stops at the end of the first value, so ``{..} x`` would pass. The
    text is therefore parsed as ``[text, "<hash of text>"]``: the hash is the second
    element exactly when the text is one complete value.
    """
    body = F.try_validate_utf8(F.col("value").cast("string"))
    parsed = (
        messages.withColumn("_text", body)
        .withColumn("_mark", F.hex(F.xxhash64("_text")))
        .withColumn(
            "_pair",
            F.try_parse_json(
                F.concat(F.lit("["), "_text", F.lit(',"'), "_mark", F.lit('"]'))
            ),
        )
    )
    complete = F.coalesce(
        F.try_variant_get(F.col("_pair"), "$[1]", "string") == F.col("_mark"), F.lit(False)
    )
    # The first character of complete JSON text settles its type.
    opens_object = F.col("_text").rlike(r"^[ \t\r\n]*\{")
    error = (
        F.when(F.col("value").isNull(), F.lit(_TOMBSTONE))
        .when(~complete, F.lit(_NOT_JSON))
        .when(
            ~opens_object,
            F.concat(F.lit(type_error), _type_name(F.col("_text")), F.lit(", expected object")),
        )
    )
    flagged = parsed.withColumn("decode_error", error)
    body = F.try_variant_get(F.col("_pair"), "$[0]", "variant")
    return _once(
        flagged, F.when(F.col("decode_error").isNull(), body), F.col("decode_error")
    ).drop("_text", "_mark", "_pair")


def _type_name(body: Column) -> Column:
    """Type names used in error texts."""
    head = F.regexp_extract(body, r"^[ \t\r\n]*(.)", 1)
    return (
        F.when(head == "[", "list")
        .when(head == '"', "str")
        .when(head.isin("t", "f"), "bool")
        .when(head == "n", "NoneType")
        .when(body.rlike("[.eE]"), "float")
        .otherwise("int")
    )


#: Timestamps keep their microseconds.
PROTO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def decode_proto_binary(message: str, descriptor_path: str, package: str = "") -> Decoder:
    """Protobuf bytes through the ``spark-protobuf`` module.

    ``to_json`` leaves unset fields out, so "unset" stays different from "zero".
    """
    _known_message(message)
    full_name = f"{package}.{message}" if package else message

    def decode(messages: DataFrame) -> DataFrame:
        from pyspark.sql.protobuf.functions import from_protobuf

        parsed = messages.withColumn(
            "_msg",
            from_protobuf(
                F.col("value"), full_name, descriptor_path, {"mode": "PERMISSIVE"}
            ),
        )
        wire_form = proto_json_form(F.col("_msg"), parsed.schema["_msg"].dataType)
        error = F.when(F.col("value").isNull(), F.lit(_TOMBSTONE)).when(
            F.col("_msg").isNull(), F.lit(f"not valid {message}")
        )
        v = F.when(error.isNull(), F.parse_json(F.to_json(wire_form, {"timestampFormat": PROTO_TIMESTAMP})))
        return _once(parsed, v, error).drop("_msg")

    return decode


def proto_json_form(value: Column, kind: T.DataType) -> Column:
    """Rewrite durations inside a message as the '3.5s' text of the JSON form."""
    if isinstance(kind, T.DayTimeIntervalType):
        full = value.cast("interval day to second")
        seconds = (
            F.extract(F.lit("DAY"), full).cast("decimal(20,6)") * 86400
            + F.extract(F.lit("HOUR"), full) * 3600
            + F.extract(F.lit("MINUTE"), full) * 60
            + F.extract(F.lit("SECOND"), full)
        )
        return F.when(value.isNotNull(), F.concat(seconds.cast("double").cast("string"), F.lit("s")))
    if isinstance(kind, T.StructType):
        inner = [proto_json_form(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*inner))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: proto_json_form(item, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, item: proto_json_form(item, kind.valueType))
    return value


def decode_proto_json(message: str) -> Decoder:
    """Protobuf topics carried in their JSON form."""
    _known_message(message)
    return decode_json


def _known_message(message: str) -> None:
    if message not in PROTO_MESSAGES:
        raise ValueError(f"no message type registered for {message!r} (known: {PROTO_MESSAGES})")


def decoder_for(
    decode_as: str, descriptor_path: str | None = None, package: str = ""
) -> Decoder:
    """``json``, ``cloudevents.json`` or a message type name.

    A message type is read as protobuf bytes when a descriptor file is given, and in
    its JSON form otherwise.
    """
    if decode_as == "cloudevents.json":
        return decode_cloudevents
    if decode_as == "json":
        return decode_json
    if descriptor_path is not None:
        return decode_proto_binary(decode_as, descriptor_path, package)
    return decode_proto_json(decode_as)
