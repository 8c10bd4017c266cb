"""Session settings and the one way this package cuts lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


STORE = "spark.sql.streaming.stateStore.providerClass"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # checkpoint files go as soon as nothing reads them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Dates are UTC calendar days everywhere, so the session zone has to be UTC.

    Python workers look for this package where the driver found it, besides their own path.
    """
    if spark.conf.get(BATCH) == "10000":  # the default: rows of long texts would make batches of a gigabyte
        spark.conf.set(BATCH, "2000")
    # streaming state on local disk with changelogs in the checkpoint, not on the heap; keyed operators with several variables need it
    if "HDFSBackedStateStoreProvider" in spark.conf.get(STORE):
        spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    places = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in places:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, places)])
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for a local master without the setting."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if configured is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            configured = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(configured)
        current = spark.sparkContext.getCheckpointDir()
    return configured or current


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the reliable checkpoint folder and go on from there.

    Used where a heavy scan has been reduced to a small table that several branches read
    (raw rows to daily bars, positions to trades): the scan then runs once per query and a
    lost executor re-reads the small table instead of the raw rows.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
