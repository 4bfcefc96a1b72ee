"""Tables in the cluster's shared folder that live as long as a computation needs them: lineage ends there, and lost executors cost nothing."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, and only in local mode, a folder of our own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        root = "file://" + tempfile.mkdtemp(prefix="plait-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: Paths made within each open ``scratch``, innermost last.
_MADE: list[list[str]] = []


def hadoop_path(spark: SparkSession, path: str):
    """(the file system that holds a path, the path) as the cluster sees them."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; it is deleted at the end of the innermost ``scratch``, or when the session ends."""
    path = f"{shared_dir(spark)}/plait-{name}-{uuid.uuid4().hex}"
    files, hadoop = hadoop_path(spark, path)
    files.deleteOnExit(hadoop)
    if _MADE:
        _MADE[-1].append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Deletes the tables that were made within it when it ends, but for those given to the function that it hands out, which the
    caller's frame still reads; these belong to the next outer scratch."""
    kept: list[str] = []
    _MADE.append([])
    try:
        yield lambda *tables: kept.extend(t.plait_path for t in tables)
    finally:
        for path in _MADE.pop():
            if path not in kept:
                files, hadoop = hadoop_path(spark, path)
                files.delete(hadoop, True)
            elif _MADE:
                _MADE[-1].append(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table in the shared folder."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.plait_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``materialize`` that nothing reads any more."""
    for table in tables:
        files, hadoop = hadoop_path(table.sparkSession, table.plait_path)
        files.delete(hadoop, True)
