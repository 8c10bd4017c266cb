"""Account state as an append-only table; the latest row is the state."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as S
from ..params import RULES, Rules

STATE_JSON = "struct<balance:string,balance_updated:string,halted:string,kill_switch_updated:string,peak_balance:string>"


def defaults(spark: SparkSession, rules: Rules = RULES) -> DataFrame:
    return spark.range(1).select(
        F.lit(None).cast("timestamp").alias("run_ts"), F.lit(rules.start_balance).alias("balance"),
        F.lit(rules.start_balance).alias("peak_balance"), F.lit(False).alias("halted"),
    )


def from_json(payloads: DataFrame, rules: Rules = RULES) -> DataFrame:
    """State rows from JSON text (column ``payload``). Missing or corrupt fields take their defaults."""
    p = F.from_json("payload", STATE_JSON)
    start = F.lit(rules.start_balance)
    parsed = payloads.withColumn("p", p)
    return parsed.select(
        F.col("p.balance_updated").try_cast("timestamp").alias("run_ts"),
        F.coalesce(S.parse_number(F.col("p.balance")), start).alias("balance"),
        F.coalesce(S.parse_number(F.col("p.peak_balance")), start).alias("peak_balance"),
        S.parse_flag(F.col("p.halted")).alias("halted"),
    )


def to_json(state: DataFrame) -> DataFrame:
    """The stored form: money to 4 digits, the flag as text."""
    stamp = F.date_format("run_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    payload = F.to_json(F.struct(
        S.half_even("balance", 4).alias("balance"), stamp.alias("balance_updated"),
        F.initcap(F.col("halted").cast("string")).alias("halted"), stamp.alias("kill_switch_updated"),
        S.half_even("peak_balance", 4).alias("peak_balance"),
    ))
    return state.select(payload.alias("payload"))


def latest(states: DataFrame) -> DataFrame:
    row = F.struct("balance", "peak_balance", "halted")
    return states.agg(F.max("run_ts").alias("run_ts"), F.max_by(row, "run_ts").alias("_s")).select("run_ts", "_s.*")


def append(state: DataFrame, path: str) -> None:
    state.select(*schemas.columns(schemas.ACCOUNT_STATE)).write.mode("append").parquet(path)


def read(spark: SparkSession, path: str, rules: Rules = RULES) -> DataFrame:
    """The latest state, or the defaults where nothing was stored: a missing path or a table without rows.

    A table of other columns or with a null in its latest state is an error, as reading it as a fresh account would clear a halt.
    """
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return defaults(spark, rules)
        raise
    found = dict(stored.dtypes)
    wanted = {f.name: f.dataType.simpleString() for f in schemas.struct(schemas.ACCOUNT_STATE)}
    if any(found.get(name) != kind for name, kind in wanted.items()):
        raise ValueError(f"{path} holds {found}, not an account state {wanted}")
    known = F.col("balance").isNotNull() & F.col("peak_balance").isNotNull() & F.col("halted").isNotNull()
    checked = F.when(known, F.col("balance")).otherwise(F.raise_error(F.lit(f"null in the latest account state of {path}")).cast("double"))
    found = latest(stored).filter(F.col("run_ts").isNotNull()).withColumn("balance", checked)
    fallback = defaults(spark, rules).withColumn("_order", F.lit(1))
    return found.withColumn("_order", F.lit(0)).unionByName(fallback).orderBy("_order").limit(1).drop("_order")
