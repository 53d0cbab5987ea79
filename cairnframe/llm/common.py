"""What the operators of this subpackage share: tables, shared folders and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch for operators that handle whole texts in Python: documents may be long.
TEXT_BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data, read through Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of texts small, unless the session already asks for smaller ones."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > TEXT_BATCH_ROWS:
        spark.conf.set(key, str(TEXT_BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (`spark.checkpoint.dir`).

    Only where none is named and one machine does all the work, as in local tests, a temporary folder is set.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cairn-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """An eager checkpoint in the shared folder: replicated by the store, so lost executors cost nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back; columnar, so smaller than a checkpoint."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/cairn-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a few numbers that may be broadcast, when counting has shown that there are no more (some 30 MB).
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(rows: DataFrame, extra: Column | None = None) -> DataFrame:
    """Cut the lineage of `rows` of a few numbers, count them, and mark them for a broadcast if they are few.

    `extra` counts the elements of an array that a row holds besides. The other side then needs no
    shuffle of its texts; beyond the bound the join stays a shuffle join.
    """
    rows = cut_lineage(rows)
    n = rows.count() if extra is None else rows.agg(F.sum(extra + 1)).first()[0] or 0
    return F.broadcast(rows) if n <= BROADCAST_ROWS else rows
