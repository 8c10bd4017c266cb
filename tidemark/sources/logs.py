"""Readers of the signal log, the trade log and stored replay results."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as S


RAW = "raw"


def blank_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(F.trim(c) != "", F.col(c)).alias(c) for c in df.columns])


def typed(df: DataFrame, ddl: str) -> DataFrame:
    """Text columns cast to the schema; what does not parse is null."""

    def cell(name: str, kind: str) -> Column:
        text = F.trim(name)
        if kind == "boolean":
            return F.when(F.col(name).isNotNull(), S.parse_flag(F.col(name))).alias(name)
        return (text if kind == "string" else text.try_cast(kind)).alias(name)

    return df.select(*[cell(f.name, f.dataType.simpleString()) for f in schemas.struct(ddl)])


def read_text(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A CSV with header as text columns by position, and the line itself, ``raw``, where it has more or fewer cells. Short rows are padded
    with nulls."""
    return spark.read.schema(schemas.all_strings(ddl).add(RAW, "string")).csv(
        path, header=True, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=RAW)


def split_signals(text: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed complete rows, legacy rows as text). A complete row has exactly 13 cells, all filled; a row with one empty
    cell or with a 14th counts as legacy and keeps its line in ``raw``."""
    names = schemas.columns(schemas.SIGNALS)
    if RAW not in text.columns:
        text = text.withColumn(RAW, F.lit(None).cast("string"))
    marked = blank_to_null(text).withColumn("n_cells", S.filled_cells(names))
    complete = (F.col("n_cells") == len(names)) & F.col(RAW).isNull()
    return typed(marked.filter(complete).select(*names), schemas.SIGNALS), marked.filter(~complete)


def read_signals(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return split_signals(read_text(spark, path, schemas.SIGNALS))


# Columns the forward comparison needs.
TRADE_COLUMNS = ["date", "symbol", "action", "entry_price", "exit_price", "pnl_net", "reason", "balance_after"]


def require(columns: list[str], needed: list[str]) -> None:
    missing = [c for c in needed if c not in columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {columns}")


def typed_trades(text: DataFrame, lenient: bool = True) -> DataFrame:
    """Trade rows: needed columns checked, bad numbers null, rows without a date dropped. ``lenient=False``
    raises on a bad cell instead."""
    require(text.columns, TRADE_COLUMNS)
    kinds = {f.name: f.dataType.simpleString() for f in schemas.struct(schemas.TRADES)}

    def cell(name: str) -> Column:
        kind, value = kinds.get(name, "string"), F.when(F.trim(name) != "", F.trim(name))
        if kind == "string":
            return value.alias(name)
        if kind == "boolean":
            return F.when(value.isNotNull(), S.parse_flag(value)).alias(name)
        return (value.try_cast(kind) if lenient else value.cast(kind)).alias(name)

    return text.select(*[cell(c) for c in text.columns]).filter(F.col("date").isNotNull())


def read_trades(spark: SparkSession, path: str, lenient: bool = True) -> DataFrame:
    header = spark.read.csv(path, header=True)  # only the header names are taken; every cell stays text
    return typed_trades(header, lenient)


def closed_and_open(trades: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Closed rows by action in any case, and everything else."""
    closed = F.coalesce(F.upper("action") == "CLOSED", F.lit(False))
    return trades.filter(closed), trades.filter(~closed)


def read_results(spark: SparkSession, path: str, run_config: str, start, end, date: str = "entry_date") -> DataFrame | None:
    """Stored replay results of one run configuration within a date window; None if there are none. The
    configuration prunes partitions and the dates reach the Parquet scan."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return stored.filter(F.col("run_config") == run_config).filter(F.col(date).between(F.lit(start), F.lit(end)))
