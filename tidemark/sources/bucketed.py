"""Tables kept in hash buckets of their join keys, so that joins, groupings and semi joins on them move nothing.

The one shuffle is paid when a table is written; every later read by the same keys starts where the rows lie. Two tables meet
without an exchange when they have the same number of buckets. A trade, signal or bar has few rows per (symbol, day), so a symbol
with most of the rows is spread over all buckets; rows without any key share one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _list(names: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in names)


def dealt(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """One task per bucket, so that a bucket is one file (per partition folder)."""
    return df.repartition(buckets, *keys)


def save(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str, partitions: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to ``path`` as the table ``name`` and return it; a table of that name is replaced. Choose ``buckets`` so that
    a bucket's rows fit a task, the same for all tables that are to meet."""
    writer = dealt(df, keys, buckets).write.format("parquet").mode("overwrite").option("path", path)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return read(df.sparkSession, name)


def attach(spark: SparkSession, name: str, path: str, keys: Sequence[str], buckets: int, partitions: Sequence[str] = ()) -> DataFrame:
    """Name a table that another session has saved, where the catalog does not outlive a session. ``keys`` and ``buckets`` must be
    those it was saved with: the files carry a bucket's number, not the rule."""
    ddl = spark.read.parquet(path)._jdf.schema().toDDL()
    folders = f"partitioned by ({_list(partitions)})" if partitions else ""
    place = path.replace("'", "\\'")
    spark.sql(
        f"create table `{name}` ({ddl}) using parquet {folders} clustered by ({_list(keys)}) sorted by ({_list(keys)}) "
        f"into {int(buckets)} buckets location '{place}'")
    if partitions:
        spark.sql(f"alter table `{name}` recover partitions")
    return read(spark, name)


def read(spark: SparkSession, name: str) -> DataFrame:
    """The table, to be merged where it lies: without the hint a small side would be broadcast, which also works but moves it."""
    return spark.table(name).hint("merge")


def replace_results(df: DataFrame, name: str, data_source: str, gate_enabled: bool, keys: Sequence[str], buckets: int, path: str) -> None:
    """Replay results under their run configuration, in buckets. A rerun replaces its own configuration only; the first run creates
    the table."""
    spark = df.sparkSession
    config = data_source + ("_ofi" if gate_enabled else "")
    if not spark.catalog.tableExists(name):
        save(df.limit(0).withColumn("run_config", F.lit(config)), name, keys, buckets, path, ["run_config"])
    wanted = [c for c in spark.table(name).columns if c != "run_config"]
    value = config.replace("'", "\\'")
    spark.sql(f"insert overwrite table `{name}` partition (run_config = '{value}') select * from {{rows}}",
              rows=dealt(df.select(*wanted), keys, buckets))
    spark.catalog.refreshTable(name)


def side_by_side(name: str, spark: SparkSession, base: str, other: str, keys: Sequence[str], value: str) -> DataFrame:
    """``value`` of both configurations per key, null where only one has the key. Both are read from the same buckets."""
    def of(config: str, alias: str) -> DataFrame:
        return read(spark, name).filter(F.col("run_config") == config).select(*keys, F.col(value).alias(alias))

    return of(base, "base").join(of(other, "other"), list(keys), "full")
