"""Tables that are written once and read again: in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, from spark.checkpoint.dir.

    Only where the session names none and driver and executors are one process (a `local` master, as in tests) a folder of
    this machine is made and set; on a cluster each executor would write to a disk of its own, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="citeloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: Names of the scratch folders that are open, outermost first; each thread has its own.
_SCRATCH: ContextVar[tuple[str, ...]] = ContextVar("scratch", default=())


def table_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, within the innermost open scratch folder."""
    return "/".join([shared_dir(spark), "citeloom", *_SCRATCH.get(), f"{name}-{uuid.uuid4().hex}"])


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = path or table_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    held.getFileSystem(spark._jsc.hadoopConfiguration()).delete(held, True)


@contextmanager
def scratch(spark: SparkSession):
    """Tables that materialize writes inside are deleted at the end; what is still to be read needs a path from outside."""
    held = _SCRATCH.set((*_SCRATCH.get(), f"scratch-{uuid.uuid4().hex}"))
    path = "/".join([shared_dir(spark), "citeloom", *_SCRATCH.get()])
    try:
        yield
    finally:
        _SCRATCH.reset(held)
        delete(spark, path)


def clear(spark: SparkSession) -> None:
    """Delete what materialize has written in the shared folder; results that are still to be read go with it."""
    delete(spark, f"{shared_dir(spark)}/citeloom")


def numbered(df: DataFrame, order: list[str | Column], name: str = "id") -> DataFrame:
    """df with a number for each row, 0, 1, ... in an order that leaves no ties.

    Rows are dealt to ranges, sorted and written; a row's number is its place in its range and the sizes of the ranges before.
    """
    # the number that is given in a sorted task counts from the task's index times 2^33
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = materialize(sorted_.select(*(f"`{c}`" for c in df.columns if c != name), F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")), "ranges")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    rows = ranged.join(F.broadcast(sizes), "_part")
    return rows.select((F.col("_base") + F.col("_place")).cast("long").alias(name), *(f"`{c}`" for c in df.columns if c != name))
