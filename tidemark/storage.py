"""The folder that driver and executors share, and names in it."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED = "spark.checkpoint.dir"
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by the session. Only a local master, whose executors live in the driver, may fall back on a temporary one."""
    named = spark.sparkContext.getConf().get(SHARED) or spark.conf.get(SHARED, None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(f"set {SHARED} to a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set(SHARED, named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A new path under the shared folder; it is removed when the interpreter ends."""
    path = f"{shared_dir(spark)}/tidemark/{tag}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Remove the files behind frames that materialise() returned and nothing will read again."""
    for df in frames:
        paths = {f.rpartition("/")[0] for f in df.inputFiles()}
        for path in paths:
            if "/tidemark/" in path:
                _remove(df.sparkSession, path)


def _remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        if spark.sparkContext._jsc is not None:
            _remove(spark, path)
