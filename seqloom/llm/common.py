"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words as all contracts of this subpackage count them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of an Arrow batch of texts, about; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20

#: Most rows of a side that is broadcast; larger sides are joined by shuffle.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession) -> None:
    """Let the session cut Arrow batches at ``BATCH_BYTES``, unless it cuts them smaller, so that a worker's memory
    does not grow with the length of ten thousand texts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)b?", spark.conf.get(key))
    if now and not 0 < int(now[1]) <= BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir.

    One is made only where none is named and everything runs on one machine (tests).
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if named is None:
        if not re.match(r"local(\[|$)", sc.master or ""):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = sc.getCheckpointDir() or tempfile.mkdtemp(prefix="spark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Cut lineage with a Parquet table in the shared folder.

    For loops: a checkpoint hands on the size that was estimated for its plan, and that of a chain of
    joins grows with each until planning takes longer than the work.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made and nothing reads any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def sized_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (already durable, so counting is cheap) with a broadcast hint if it is small enough."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def in_order(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with place (1, 2, 3...) in ``order``, which should leave no ties.

    Rows are dealt by ranges of that order and sorted range by range; the driver sees one count a range.
    """
    ranges = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, nth = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit(2**33 - 1))
    before, starts = 0, []
    for r in ranges.groupBy(part.alias("part")).count().orderBy("part").collect():
        starts.append((r["part"], before))
        before += r["count"]
    offsets = df.sparkSession.createDataFrame(starts, "part long, before long")
    placed = ranges.withColumn("part", part).join(F.broadcast(offsets), "part")
    return placed.select(*df.columns, (F.col("before") + nth + 1).alias("place"))


def utf8_bytes(text: Column) -> Column:
    return F.octet_length(text)


def unsigned_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
