"""Messages from Python values, and rows back as Python values."""

import json

from pyspark.sql import functions as F

from readmill.plans.batch import Settings, project_messages
from readmill.plans.projections import get_projection, table_columns
from readmill.sources.envelopes import MESSAGE_SCHEMA

AS_OF_US = 1_700_000_000_000_000


def as_of():
    return F.timestamp_micros(F.lit(AS_OF_US))


def messages(spark, bodies, topic="t", keys=None):
    """Bodies may be dicts (sent as JSON), text, bytes or None."""

    def raw(body):
        if body is None or isinstance(body, (bytes, bytearray)):
            return body
        return (body if isinstance(body, str) else json.dumps(body)).encode()

    rows = []
    for offset, body in enumerate(bodies):
        key = keys[offset] if keys else "key-1"
        rows.append((None if key is None else bytearray(key.encode()), raw(body), topic, 0, offset, None))
    rows = [(k, None if v is None else bytearray(v), *rest) for k, v, *rest in rows]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def projected(spark, name, bodies, settings=Settings(), keys=None):
    """One dict per message, in order: outcome, errors and the table's columns."""
    projection = get_projection(name)
    df = project_messages(messages(spark, bodies, projection.topic, keys), projection, settings, as_of())
    columns = []
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if kind == "variant":
            columns.append(F.to_json(field.name).alias(field.name))
        elif kind == "timestamp":
            columns.append(F.unix_micros(field.name).alias(field.name))
        else:
            columns.append(F.col(field.name))
    rows = [r.asDict() for r in df.select(*columns).orderBy("offset").collect()]
    assert set(table_columns(projection, df)) <= set(rows[0])
    return rows


def one(spark, name, body, **more):
    return projected(spark, name, [body], **more)[0]
