"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# All of these may be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A symbol made of digits stays text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def lake_session(app: str = "tidelake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return use_lake_settings(builder.getOrCreate())


def use_lake_settings(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on (UTC above all) on an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def spread(spark: SparkSession) -> int:
    """Partitions for rows that are about to become many more.

    Adaptive execution sizes partitions by their bytes before the expansion, and would put it all into a few tasks; a
    partition count that is asked for by number is left alone.
    """
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is only made for a local master that names none.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    local = tempfile.mkdtemp(prefix="tidelake-")
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name for one run below :func:`scratch_root`."""
    return f"{scratch_root(spark)}/tidelake/{label}-{uuid.uuid4().hex}"
