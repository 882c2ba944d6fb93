"""Tables written on the way, where the driver and all executors can read them."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; in local mode, where it is unset, a folder of our own, removed at exit."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="wikiloom-")
        atexit.register(shutil.rmtree, _own[app], True)
    return _own[app]


def stage(df: DataFrame, name: str = "pages") -> DataFrame:
    """Write ``df`` as Parquet and read it again: what follows is planned on a table, and lost executors cost no more than their tasks."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
