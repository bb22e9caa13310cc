"""Session defaults and the shared working folder of a run."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Clock text and epoch conversions are defined in UTC everywhere in the package.
TIME_ZONE = "UTC"
# Rows of a batch for Python; texts are long, so fewer than Spark's default.
BATCH_ROWS = 1000
ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the engine relies on; a cluster supplies its own master."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": TIME_ZONE,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> None:
    """Put a session somebody else made into the state the engine expects."""
    spark.conf.set("spark.sql.session.timeZone", TIME_ZONE)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` when the session names one.

    Without that setting a session on one machine (a test) gets a temporary folder; a cluster
    must name one, since its machines share no local folder. Reliable checkpoints go there too.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not context.getCheckpointDir():
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="sigweave-"))
    return (named or context.getCheckpointDir()).rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Reliable checkpoint of ``df`` in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
