"""Session helpers: where intermediate tables live and when a side may be broadcast."""

from __future__ import annotations

import io
import tempfile
import threading
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
"""Rows up to which a counted side is broadcast (at most some 200 bytes each: 40 MB)."""


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in ``spark.checkpoint.dir``.

    Only a local session without a checkpoint folder gets a temporary one, set for its whole life.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="barwatch-"))
    return context.getCheckpointDir()


def own_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark)}/barwatch/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession) -> str:
    """Path of a folder that does not exist yet."""
    return f"{own_folder(spark)}/{uuid.uuid4().hex}"


def drop_intermediate(spark: SparkSession) -> None:
    """Delete what this application has put into the shared folder; call it when a job is done."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(own_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: survives lost executors."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a stored ``table`` has at most ``max_rows`` rows; counts no further."""
    return table.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored ``table`` for broadcasting if it has at most ``max_rows`` rows.

    Beyond that the join is left to shuffle, where adaptive execution splits hot keys.
    """
    return F.broadcast(table) if is_small(table, max_rows) else table


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Over all shuffle partitions, for steps with few bytes and much arithmetic per row.

    Adaptive execution sizes partitions by bytes and would run such a step in one task.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *keys)


_shipped: set[str] = set()
_shipping = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, for functions that run in their Python workers.

    Spark hands the archive to every executor, also to those that join later.
    """
    context = spark.sparkContext
    with _shipping:
        if context.applicationId in _shipped:
            return
        top = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="package-")) / "barwatch_package.zip"
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as out:
            for source in sorted(top.rglob("*.py")):
                out.write(source, source.relative_to(top.parent))
        archive.write_bytes(packed.getvalue())
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
