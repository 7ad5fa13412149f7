"""Built tables that queries share, written once a session for each state of their input."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_PATHS: dict[tuple, str] = {}


def folder(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; where the session has none, a local session gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def state(spark: SparkSession, path: str) -> str:
    """A digest of the path, time of change and length of every file under a path: another state is another input.

    Folders are listed one call each; when files were last read does not count.
    """
    found, todo = [], [path]
    while todo:
        at = spark._jvm.org.apache.hadoop.fs.Path(todo.pop())
        text = spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at))
        found.append(re.sub(r"access_time=\d+", "", text))
        todo += re.findall(r"path=([^;]+); isDirectory=true", text)
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def kept(spark: SparkSession, name: str, inputs: list[str], build: Callable[[], DataFrame], order: str) -> str:
    """The path of table `name` built from `inputs`. It is written where it is missing, the rows of each file in order of a column.

    Filters on that column skip row groups and pages by their bounds; files keep the partitions the table was computed in, so
    writing takes no further shuffle. A table is known by the state of its inputs' files.
    """
    key = (spark.sparkContext.applicationId, name, *(state(spark, p) for p in inputs))
    if key not in _PATHS:
        path = f"{folder(spark)}/harborline-{name}-{uuid.uuid4().hex}"
        build().sortWithinPartitions(order).write.parquet(path)
        _PATHS[key] = path
    return _PATHS[key]


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table of the shared folder, read back: the lineage is cut, and lost executors cost nothing computed before."""
    spark = df.sparkSession
    path = f"{folder(spark)}/harborline-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._harborline_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what `written` wrote, once nothing still to be computed reads it."""
    for df in frames:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._harborline_path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
