"""Ordered work on long series without putting a whole series into one task.

Two tools cover every ordered operator of the package:

``running``  unbounded totals, maxima and forward fills. Each bucket (a calendar year of a symbol, a
             range partition of a global order) is scanned alone; only one row per bucket is ordered
             across buckets, and its carry is joined back.
``blocks``   bounded look-back or look-ahead. Rows get a block by ordinal, and the few rows a
             neighbouring block needs are copied into it, so windows run per (key, block).

A symbol holding a third of all bars is therefore spread over as many tasks as it has buckets or blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# With the longest look-back (1000 rows) a window group stays below 4096 rows, up to which Spark's window
# operator buffers in plain memory instead of a spillable sorter.
BLOCK_ROWS = 3072


def _spec(columns: list[str]):
    return Window.partitionBy(*columns) if columns else Window.partitionBy(F.lit(0))


def running(df: DataFrame, keys: list[str], order: list[str], bucket: str, **outs: tuple) -> DataFrame:
    """Add running values over ``order`` per ``keys``.

    ``bucket`` must not decrease along ``order``. ``df`` is read by two branches: pass a table or a
    materialized frame where it is costly. Each keyword names an output and gives
    ``("count",)``, ``("sum", col)``, ``("sum_before", col)``, ``("max", col)``,
    ``("max_before", col)`` or ``("last", col)`` (last non-null value).
    """
    part = [*keys, bucket]
    upto = _spec(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = _spec(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = _spec(keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    # rows with equal order values still get one place each, so a bucket's total is its last row's value
    place = F.row_number().over(_spec(part).orderBy(*order)).alias("_place")
    position = F.col("_place")

    inside, totals, carries, finals = [place], [], [], []
    for name, spec in outs.items():
        kind = spec[0]
        value = F.col(spec[1]) if len(spec) > 1 else F.lit(1)
        here, total, carry = f"_{name}_here", f"_{name}_total", f"_{name}_carry"
        if kind in ("count", "sum", "sum_before"):
            inside.append(F.sum(value).over(upto).alias(f"{here}_to"))
            # the bucket total is the last inside value, so no row sees two different roundings of it
            totals.append(F.max_by(F.col(f"{here}_to"), position).alias(total))
            if kind == "sum_before":
                inside.append(F.sum(value).over(before).alias(here))
            else:
                inside.append(F.sum(value).over(upto).alias(here))
            carries.append(F.coalesce(F.sum(total).over(earlier), F.lit(0)).alias(carry))
            finals.append((F.col(carry) + F.coalesce(F.col(here), F.lit(0))).alias(name))
        elif kind in ("max", "max_before"):
            inside.append(F.max(value).over(upto if kind == "max" else before).alias(here))
            totals.append(F.max(value).alias(total))
            carries.append(F.max(total).over(earlier).alias(carry))
            finals.append(F.greatest(F.col(carry), F.col(here)).alias(name))
        elif kind == "last":
            inside.append(F.last(value, ignorenulls=True).over(upto).alias(here))
            totals.append(F.max_by(value, F.when(value.isNotNull(), position)).alias(total))
            carries.append(F.last(total, ignorenulls=True).over(earlier).alias(carry))
            finals.append(F.coalesce(F.col(here), F.col(carry)).alias(name))
        else:
            raise ValueError(kind)
    scanned = df.select("*", *inside)
    carried = scanned.groupBy(*part).agg(*totals).select(*part, *carries)
    return scanned.join(carried, part).select(*[F.col(c) for c in df.columns], *finals)


def year_bucket(date: str = "date") -> Column:
    """A daily series has at most 366 rows a year, so this bounds a bucket."""
    return F.year(date)


def ordinals(df: DataFrame, keys: list[str] = ["symbol"], date: str = "date", name: str = "rn") -> DataFrame:
    """Row number from 1 along ``date`` per key. ``df`` is read by two branches: pass a table or a
    materialized frame."""
    numbered = running(df.withColumn("_year", year_bucket(date)), keys, [date], "_year", **{name: ("count",)})
    return numbered.drop("_year")


def blocks(df: DataFrame, back: int, ahead: int = 0, rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``block`` and ``own``; rows needed by a neighbouring block appear there with ``own`` false.

    Needs ``rn``. The copies cost ``(back + ahead) / rows`` extra rows; a series shorter than
    ``rows`` is one block.
    """
    at = F.col("rn") - 1
    first = F.floor(F.greatest(at - ahead, F.lit(0)) / rows)
    last = F.floor((at + back) / rows)
    copied = df.select("*", F.explode(F.sequence(first, last)).alias("block"))
    return copied.select("*", (F.col("block") == F.floor(at / rows)).alias("own"))


def since(df: DataFrame, day, back: int, keys: list[str] = ["symbol"], date: str = "date") -> DataFrame:
    """Rows from ``day`` on and the ``back`` rows before them, per key: what a run over new days has to read.
    A date filter above a row window cannot move below it, so the history is cut here, by ordinal, before
    the windows. Needs ``rn``."""
    first = df.filter(F.col(date) >= F.lit(day)).groupBy(*keys).agg(F.min("rn").alias("_first"))
    return df.join(first, keys).filter(F.col("rn") >= F.col("_first") - back).select(*df.columns)


def block_window(keys: list[str] = ["symbol"]):
    return Window.partitionBy(*keys, "block").orderBy("rn")


def owned(df: DataFrame) -> DataFrame:
    """Drop the copied rows after the windows have run."""
    return df.filter("own").drop("own", "block")


def ordered_parts(df: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """Range-partition by a global order and write the result, with the partition number in ``_part``.

    ``_part`` is then a valid bucket for ``running`` with no keys. The order columns should identify a
    row, so that a hot value is split like any other. The boundaries come from sampling, hence the
    write: both branches of ``running`` must see the same ones.
    """
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return materialize(ranged.withColumn("_part", F.spark_partition_id()))


def global_running(df: DataFrame, order: list[str], parts: int | None = None, **outs: tuple) -> DataFrame:
    """``running`` over one global order, spread over range partitions."""
    return running(ordered_parts(df, order, parts), [], order, "_part", **outs).drop("_part")
