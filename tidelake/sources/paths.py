"""Folders that may not exist, and listings that open no file."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_if_there(spark: SparkSession, base: str, path: str, schema: T.StructType) -> DataFrame | None:
    """Parquet rows below ``path``, with partition columns from ``base`` on; None where nothing is there."""
    reader = spark.read.schema(schema).option("basePath", base).option("pathGlobFilter", "*.parquet")
    try:
        return reader.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def choice(values: str | list[str] | None) -> str:
    """A path level that is one of ``values``, or any."""
    if values is None:
        return "*"
    return values if isinstance(values, str) else "{" + ",".join(values) + "}"


def list_artifacts(spark: SparkSession, root: str) -> DataFrame | None:
    """Parquet files below ``root`` with their modification time; no file is opened. None when nothing is there."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    try:
        return reader.load(root).select("path", "modificationTime")
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
