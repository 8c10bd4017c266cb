"""Table writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as S
from ..params import RULES, Rules

TABLES = {"signals": schemas.SIGNALS, "trades": schemas.TRADES, "account_state": schemas.ACCOUNT_STATE}


def create_missing(spark: SparkSession, root: str) -> list[str]:
    """Create the empty tables that do not exist yet; returns their names."""
    created = []
    for name, ddl in TABLES.items():
        path = f"{root}/{name}"
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            spark.createDataFrame([], schemas.struct(ddl)).write.parquet(path)
            created.append(name)
    return created


def signal_rows(logged: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Admission results in the signal log's presentation. Expects close, prob, rf_prob, xgb_prob, rsi and
    atr_pct."""
    passed = F.when(F.col("ofi") > rules.flow_gate, "YES").otherwise("NO")
    return logged.select(
        "date", "symbol", S.half_even("close", 6).alias("close"), S.half_even("prob", 4).alias("ensemble_prob"),
        S.half_even("rf_prob", 4).alias("rf_prob"), S.half_even("xgb_prob", 4).alias("xgb_prob"),
        "signal_fired", "reject_reason", S.half_even("ofi", 4).alias("ofi_value"), passed.alias("ofi_gate_pass"),
        S.half_even("rsi", 2).alias("rsi"), S.half_even(F.col("atr_pct") * 100, 4).alias("atr_pct"), "in_position",
    )


def append_signals(rows: DataFrame, path: str) -> None:
    """Append under monthly folders: a folder per day would hold a few rows each over a long history. Rows of
    a month are spread by symbol, so a month with most of the rows is not one task."""
    monthly = rows.withColumn("month", F.date_format("date", "yyyy-MM"))
    monthly.repartition("month", "symbol").write.mode("append").partitionBy("month").parquet(path)


def read_signals(spark: SparkSession, path: str, start: Column, end: Column) -> DataFrame:
    """Signals of a date window; the month prunes folders, the dates reach the scan."""
    month = F.col("month").between(F.date_format(start, "yyyy-MM"), F.date_format(end, "yyyy-MM"))
    return spark.read.parquet(path).filter(month & F.col("date").between(start, end)).drop("month")


def append_trades(rows: DataFrame, path: str) -> None:
    rows.select(*schemas.columns(schemas.TRADES)).write.mode("append").parquet(path)


def write_results(df: DataFrame, path: str, data_source: str, gate_enabled: bool) -> None:
    """Replay results under their run configuration."""
    config = data_source + ("_ofi" if gate_enabled else "")
    df.withColumn("run_config", F.lit(config)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("run_config").parquet(path)


def run_config(data_source: Column, gate_enabled: Column) -> Column:
    return F.concat(data_source, F.when(gate_enabled, "_ofi").otherwise(""))
