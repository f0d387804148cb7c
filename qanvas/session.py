"""A session with the settings that the library expects. On a cluster the cluster's own settings win."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def session(name: str = "qanvas", **conf: str) -> SparkSession:
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    builder = SparkSession.builder.appName(name)
    for k, v in {**base, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder in the one that driver and executors share (spark.checkpoint.dir). In local mode, with one machine, an
    unset one is set; on a cluster that raises."""
    at = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="checkpoints-")
        spark.sparkContext.setCheckpointDir(at)
    return f"{at.rstrip('/')}/{what}-{uuid.uuid4().hex}"
