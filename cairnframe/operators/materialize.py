"""Lineage cuts in the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; a temporary one only where none is named and one machine does all the work."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not named and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="cairn-checkpoint-"))
    return named or context.getCheckpointDir()


def mounted_folder(spark: SparkSession, name: str) -> Path:
    """A new folder below the shared one, which driver and executors must see as a folder of their own."""
    at = urlparse(shared_folder(spark))
    if at.scheme not in ("", "file"):
        raise ValueError("files are written to a mounted folder")
    out = Path(at.path) / f"cairn-{name}-{uuid.uuid4().hex}"
    out.mkdir(parents=True)
    return out


#: Tasks for each core over which rows are spread that cost much more to work on than to read.
SPREAD = 4


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by their keys over all cores: a file of few bytes is read by few tasks, however much each of its rows costs."""
    return rows.repartition(SPREAD * rows.sparkSession.sparkContext.defaultParallelism, *keys)


def cut_lineage(df: DataFrame) -> DataFrame:
    """An eager checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows of a few numbers and short names that may be broadcast, when counting has shown that there are no more (some 50 MB).
BROADCAST_ROWS = 500_000


def broadcast_if_few(rows: DataFrame, otherwise: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """`rows` with their lineage cut, marked for a broadcast if they are few; beyond the bound joins with them shuffle."""
    rows = cut_lineage(rows)
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else otherwise(rows)
