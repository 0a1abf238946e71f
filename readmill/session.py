"""Session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the one option decoding depends on: repeated JSON keys, last one wins."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


#: Folders of local sessions that name none, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a local one only for a local session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    # The setting is fixed when a session starts, so the folder is remembered here.
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="readmill-")
    return _LOCAL_FOLDERS[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/readmill/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage by writing to the shared folder and reading it back.

    Survives the loss of any executor, and gives the following joins exact sizes.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_library(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver did.

    Where that folder is not on the executors, install the library there or pass it with ``--py-files``.
    """
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])
