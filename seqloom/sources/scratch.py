"""A folder for tables that a job writes and reads again."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir).

    A folder of this machine is taken only where none is named and everything runs here (tests).
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if named is None:
        if not re.match(r"local(\[|$)", sc.master or ""):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = sc.getCheckpointDir() or tempfile.mkdtemp(prefix="spark-")
    return f"{named}/{uuid.uuid4().hex}"


class Table:
    """A DataFrame, written to a new path of the shared folder and read again, which cuts its lineage.

    For loops, whose tables are dropped once their successors are written.
    """

    def __init__(self, df: DataFrame):
        self.path = scratch(df.sparkSession)
        df.write.parquet(self.path, compression="zstd")
        self.df = df.sparkSession.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        sc = self.df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
