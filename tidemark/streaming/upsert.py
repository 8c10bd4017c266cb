"""Closing ledger rows from a stream of exits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ledger
from ..session import materialize
from .versions import Versions

MONTH = "entry_month"


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.date_format("date", "yyyy-MM"))


def write_ledger(rows: DataFrame, path: str) -> None:
    """Add rows to the ledger, which begins with the first ones."""
    Versions(rows.sparkSession, path, MONTH).append(with_month(rows))


def read_ledger(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The ledger as its last complete write left it, or as of an earlier version."""
    return Versions(spark, path, MONTH).read(version)


def merge_batch(exits: DataFrame, path: str, source: str | None = None, batch: int | None = None) -> None:
    """Merge one batch into the ledger, rewriting only the entry months it touches. Closing a closed row
    again gives the same row, so a repeated batch changes nothing; a numbered one is not even merged again. Readers see the ledger
    before the batch or after it, also if the merge fails in the middle or another writer is at work."""
    exits = materialize(with_month(exits))
    # one value per calendar month at most
    months = [row[0] for row in exits.select(MONTH).distinct().collect()]
    if not months:
        return
    Versions(exits.sparkSession, path, MONTH).replace(
        months, lambda rows: with_month(ledger.close_trades(rows.drop(MONTH), exits.drop(MONTH))), source, batch)


def upsert(exits: DataFrame, path: str, offsets: str) -> None:
    """Run the merge over everything available in the stream; ``offsets`` names the stream, whose batches are merged once."""
    running = (
        exits.writeStream.foreachBatch(lambda batch, number: merge_batch(batch, path, offsets, number))
        .option("checkpointLocation", offsets).trigger(availableNow=True).start()
    )
    running.awaitTermination()
