"""Messages of one topic -> projected rows, as one DataFrame plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readmill.operators.coalesce import ARRIVAL, coalesce_messages, earliest_per_key, latest_per_key
from readmill.operators.decode import decoder_for
from readmill.operators.monitor import FALLBACK_WINDOW_S
from readmill.operators.provenance import Resolver
from readmill.operators.quarantine import good_rows
from readmill.plans.projections import Projection, narrowed, project, table_columns


@dataclass(frozen=True)
class Settings:
    """Deployment choices shared by all projections.

    ``coalesce`` is "row_key" (decode, then keep the last good row of a table key) or
    "message_key" (keep the last message of a message key, then decode).

    The last two are the window of the streams' fallback reports, and how long a count that was
    not reported is remembered, in seconds.
    """

    resolver: Resolver = Resolver()
    enums: Mapping[str, Mapping[int, str]] = field(default_factory=dict)
    coalesce: str = "row_key"
    descriptor_path: str | None = None
    proto_package: str = ""
    fallback_window_s: int = FALLBACK_WINDOW_S
    fallback_keep_s: int = 24 * 3600


def project_messages(
    messages: DataFrame,
    projection: Projection,
    settings: Settings = Settings(),
    as_of: Column | None = None,
) -> DataFrame:
    """Decode and project; one row per message, whatever its outcome."""
    if settings.coalesce == "message_key":
        messages = coalesce_messages(messages, projection.mode)
    elif settings.coalesce != "row_key":
        raise ValueError(f"unknown coalesce mode: {settings.coalesce!r}")
    decode = decoder_for(projection.decode_as, settings.descriptor_path, settings.proto_package)
    return project(decode(messages), projection, settings.resolver, as_of, settings.enums)


def rows_to_write(projected: DataFrame, projection: Projection, only: Sequence[str] | None = None) -> DataFrame:
    """One row per table key with its arrival position: last for upsert, first for append.

    ``only`` names the columns that are wanted besides the keys.
    """
    columns = [c for c in table_columns(projection, projected) if only is None or c in {*projection.keys, *only}]
    rows = good_rows(projected).select(*columns, *ARRIVAL)
    pick = latest_per_key if projection.mode == "upsert" else earliest_per_key
    return pick(rows, list(projection.keys))


def read_model(
    messages: DataFrame,
    projection: Projection,
    settings: Settings = Settings(),
    as_of: Column | None = None,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """The table a full replay of the messages leads to.

    Of columns that ``only`` (if given) does not name nothing is computed, sorted or moved but the checks on them, which
    decide whether a message counts. Spark does not see this by itself, as a key's row is picked whole.
    """
    if only is not None:
        projection = narrowed(projection, only)
    rows = rows_to_write(project_messages(messages, projection, settings, as_of), projection, only)
    return rows.drop(*ARRIVAL)


def blobs_as_json(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """VARIANT columns as JSON text for sinks without the type; NULL stays NULL."""
    return rows.withColumns({n: F.to_json(F.col(n)) for n in names if n in rows.columns})
