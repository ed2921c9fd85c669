"""Places every executor can reach: work folders, file-system helpers."""

from __future__ import annotations

import tempfile
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The Hadoop file system of a path, and the path on it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, removed when the session's JVM ends.

    Only a local session may do without that setting; it then gets a temporary
    folder.  On a cluster a machine-local folder would be lost with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.gettempdir()
    path = f"{base.rstrip('/')}/streamsync-{name}-{uuid.uuid4().hex}"
    fs, place = file_system(spark, path)
    fs.mkdirs(place)
    fs.deleteOnExit(place)
    return path
