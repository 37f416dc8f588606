"""Session options and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_OPTIONS = {
    # Zone-less wire timestamps must not depend on the machine's zone.
    "spark.sql.session.timeZone": "UTC",
    # A key repeated inside a JSON object keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # State of streams, such as the names of records seen, may outgrow the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
    # Recording the Python call site of every column takes longer than planning a wide query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_local_scratch: dict[str, str] = {}


def build_session(app_name: str, master: str | None = None, **options: str) -> SparkSession:
    """A session with the options every feed job relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SESSION_OPTIONS, **options}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory name for intermediate tables, under ``spark.checkpoint.dir``.

    On a cluster that setting has to name a folder all executors share; a temporary folder is made
    up only for a local master, where driver and executors are one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        if context.applicationId not in _local_scratch:
            _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="feedloom-")
        base = _local_scratch[context.applicationId]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
