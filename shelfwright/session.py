"""Session settings and the lineage cut used by the iterative and ordered operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

TASKS_A_CORE = 3


def build_session(app: str = "shelfwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators count on; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary one; a cluster without the setting is an error,
    because a folder on one machine does not survive the loss of that machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame, eager: bool = True) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    With ``eager`` off it is the caller's next action that writes it.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to some tasks a core: for rows that are few bytes and much work, which a table in one file
    would leave to one task."""
    return df.repartition(TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism, *keys)
