"""Shared by the operators: cut tables, slices of Arrow batches, connected classes."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and go on from the files.

    What has been written does not depend on the executors that made it, and each column is read alone.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def discard(*tables: DataFrame | None) -> None:
    """Delete what ``written`` has written, once nothing that is still to be computed reads it."""
    for table in tables:
        path = getattr(table, "_written_to", None)
        if path is not None:
            context = table.sparkSession.sparkContext
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def cleaned(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are done: it does so when the driver's JVM collects what referred to them, which may
    be long after, while the next step fills the disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release() -> None:
    """Give memory that earlier work has freed back to the system: a worker lives on, and what it holds counts for its executor."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of ``column``; one row is never cut."""
    release()
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.diff(np.cumsum(sizes.astype(np.int64)) // most, prepend=-1))
        for start, end in zip(starts, [*starts[1:], len(sizes)], strict=True):
            yield batch.slice(int(start), int(end - start))
    release()


def classes(edges: DataFrame, name: str = "classes", rounds: int = 60) -> DataFrame:
    """Connected classes of the undirected ``edges`` (a, b): rows (node, root), root the smallest node of the class.

    Large-star and small-star steps alternate until only stars are left: every edge is turned into links to
    the smallest neighbour, so the number of edges never grows and a hub's rows are one aggregate and one join, which
    the engine can split. The rounds grow as the logarithm of the longest chain. Nodes without an edge are not returned.
    """
    spark = edges.sparkSession
    current = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    for _ in range(rounds):
        both = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # each edge (u, v) has v < u from here on
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where("u <> v").distinct())
        earlier, current = current, written(small, name)
        discard(earlier)
        # done when every node has one edge at most as the larger end, and none if it is the smaller end of another
        ends = current.select("u").unionByName(current.select(F.col("v").alias("u")).distinct())
        if ends.groupBy("u").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError(f"classes did not settle in {rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
