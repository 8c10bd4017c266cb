"""Parsing of landed market data into typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from .. import schemas
from ..functions import scalars as S
from ..params import RULES

# Positions in a raw kline.
OPEN_MS, OPEN, HIGH, LOW, CLOSE, VOLUME, TAKER = 0, 1, 2, 3, 4, 5, 9


def kline_number(index: int) -> Column:
    return F.get(F.col("k"), F.lit(index)).try_cast("double")


def parse_klines(raw: DataFrame) -> DataFrame:
    """Typed columns from positional text cells; nothing is filtered yet."""
    ms = F.get(F.col("k"), F.lit(OPEN_MS)).try_cast("bigint")
    return raw.select(
        "symbol", "ingest_seq", ms.alias("ts"),
        kline_number(OPEN).alias("open"), kline_number(HIGH).alias("high"), kline_number(LOW).alias("low"),
        kline_number(CLOSE).alias("close"), kline_number(VOLUME).alias("volume"),
    )


def first_ingested(klines: DataFrame) -> DataFrame:
    """One row per (symbol, ts): the first ingested. A min_by combines on the map side, so a bar repeated
    any number of times costs one row per task; one per column, as numbers can be aggregated by hash without sorting the raw rows.
    ``ingest_seq`` is unique, so all columns come from the same row."""
    rest = [c for c in klines.columns if c not in ("symbol", "ts", "ingest_seq")]
    return klines.groupBy("symbol", "ts").agg(*[F.min_by(c, "ingest_seq").alias(c) for c in rest])


def valid_bars(df: DataFrame) -> DataFrame:
    """Bars without nulls and with a positive close."""
    return df.dropna().filter(F.col("close") > 0)


def bars_from_klines(raw: DataFrame, dedup: bool = True) -> DataFrame:
    """Klines to bars: UTC day of the open time, first copy of a duplicate, valid rows only."""
    klines = parse_klines(raw)
    if dedup:
        klines = first_ingested(klines)
    return valid_bars(
        klines.select(
            "symbol", S.millis_to_date(F.col("ts")).alias("date"), "open", "high", "low", "close", "volume"
        )
    )


def flow_from_klines(raw: DataFrame) -> DataFrame:
    """Flow ratio per (symbol, day); rows without volume are skipped."""
    total, taker = kline_number(VOLUME), kline_number(TAKER)
    ms = F.get(F.col("k"), F.lit(OPEN_MS)).try_cast("bigint")
    return (
        raw.select("symbol", S.millis_to_date(ms).alias("date"), total.alias("total"), taker.alias("taker"))
        .filter("total > 0")
        .select("symbol", "date", S.flow_ratio(F.col("taker"), F.col("total")).alias("ofi"))
    )


SENTIMENT_JSON = "struct<data:array<struct<timestamp:string,value:string>>>"


def parse_sentiment(payloads: DataFrame) -> DataFrame:
    """(date, value) from ``payload`` JSON. A duplicate day keeps the last entry of the last payload; a bad
    payload yields nothing. ``payload_seq`` orders the payloads."""
    parsed = payloads.select("payload_seq", F.from_json("payload", SENTIMENT_JSON).alias("p"))
    entries = parsed.select("payload_seq", F.posexplode("p.data").alias("pos", "e"))
    typed = entries.select(
        S.seconds_to_date(F.col("e.timestamp").try_cast("bigint")).alias("date"),
        F.col("e.value").try_cast("int").alias("value"), "payload_seq", "pos",
    ).dropna(subset=["date", "value"])
    return typed.groupBy("date").agg(F.max_by("value", F.struct("payload_seq", "pos")).alias("value"))


def parse_book(raw: DataFrame) -> DataFrame:
    """Snapshots with price/size levels cut to the depth; a third field of a level is ignored."""

    def cut(side: str) -> Column:
        top = F.slice(F.col(side), 1, P.BOOK_DEPTH)
        return F.transform(top, lambda lv: F.array(F.get(lv, F.lit(0)), F.get(lv, F.lit(1)))).alias(side)

    return raw.select("symbol", "ts", cut("bids"), cut("asks"))


def top_levels(levels: DataFrame, depth: int = P.BOOK_DEPTH) -> DataFrame:
    """Snapshots (symbol, ts, bids, asks) from loose levels (symbol, date, side, price, size), side O/F.

    Bids rank from the highest price, asks from the lowest; ties by size. The rank filter is applied per
    map task first (window group limit), so a snapshot with any number of levels moves ``depth`` rows per
    task, and only ``depth`` rows per side are collected.
    """
    signed = levels.withColumn("_key", F.when(F.col("side") == "O", -F.col("price")).otherwise(F.col("price")))
    w = Window.partitionBy("symbol", "date", "side").orderBy("_key", "size")
    top = signed.withColumn("level", F.row_number().over(w)).filter(F.col("level") <= depth)
    pair = F.struct("level", F.array("price", "size").alias("lv"))

    def side(code: str, name: str) -> Column:
        picked = F.sort_array(F.collect_list(F.when(F.col("side") == code, pair)))
        return F.transform(picked, lambda x: x["lv"]).alias(name)

    return top.groupBy("symbol", F.col("date").cast("timestamp").alias("ts")).agg(side("O", "bids"), side("F", "asks"))


def enough_history(df: DataFrame, minimum: int = RULES.min_history) -> DataFrame:
    """Rows of symbols with at least ``minimum`` bars. The count is one row per symbol; joining it back
    keeps the bars where they are instead of ordering a whole symbol."""
    enough = df.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_bars")).filter(F.col("n_bars") >= minimum)
    return df.join(enough, "symbol")


def bar_state(last_date: Column, run_date: Column) -> Column:
    """A symbol's last bar is partial if it is not before the run date."""
    return F.when(last_date >= run_date, "partial").otherwise("complete")


def latest_complete(df: DataFrame, run_date: Column) -> DataFrame:
    """Only yesterday's bar; a symbol without it yields nothing."""
    return df.filter(F.col("date") == F.date_sub(run_date, 1))


def read_bars(spark, path: str) -> DataFrame:
    return spark.read.schema(schemas.BARS).parquet(path)
