"""Streaming queries (T1-T6), each drained over the given tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import exits, indicators, ledger
from ..params import RULES
from ..session import materialize, scratch_path
from ..streaming import bars as SB
from ..streaming import state as SS
from ..streaming import upsert as SU
from . import inputs
from .q_positions import EXIT_SQL, show_exits
from .q_results import rounded
from .registry import query
from .sqlparts import d, part, r, sql

part("tick_days", [], """
select event_type as symbol, cast(ts as date) as date, arg_min(value, (ts, event_id)) as open, max(value) as high, min(value) as low,
       arg_max(value, (ts, event_id)) as close, cast(count(*) as double) as volume
from events group by 1, 2
""")
part("complete_days", [], "select distinct cast(ts as date) as date from events where cast(ts as date) + interval 1 day <= (select max(ts) - interval 1 hour from events)")


@query("t01_tick_bars", sql("select * from tick_days"" where date in (select date from complete_days)", "tick_days", "complete_days"))
def t01(spark, sf):
    stream = SB.daily_bars(SB.ticks(SB.read_table(spark, sf, "events")))
    return SB.run_to_table(stream, "tick-bars")


@query("t02_held_back_days", sql("""
select symbol, date, date in (select date from complete_days) as emitted from tick_days""", "tick_days", "complete_days"))
def t02(spark, sf):
    emitted = SB.run_to_table(SB.daily_bars(SB.ticks(SB.read_table(spark, sf, "events"))), "tick-bars")
    seen = SB.ticks(inputs.table(spark, sf, "events")).select("symbol", F.to_date("ts").alias("date")).distinct()
    marked = emitted.select("symbol", "date", F.lit(True).alias("emitted"))
    return seen.join(marked, ["symbol", "date"], "left").withColumn("emitted", F.coalesce("emitted", F.lit(False)))


part("account_days", [], """
select cast(user_id as varchar) as account, cast(ts as date) as date, max(event_type = 'signup') as reset,
  sum(case event_type when 'error' then -10*value when 'purchase' then 6*value else 0 end) as net
from events group by 1, 2
""")
part("account_path", ["account_days", "complete_days"], """
select *, greatest(max(balance) over (partition by account order by date rows between unbounded preceding and current row), 10000) as peak,
  count(*) filter (reset) over (partition by account order by date rows between unbounded preceding and current row) as epoch
from (select *, cast(10000 as double) + sum(net) over (partition by account order by date rows between unbounded preceding and current row) as balance
      from account_days where date in (select date from complete_days))
""")


@query("t03_latched_halt", sql(f"""
select account, date, {r('balance', 4)} as balance, {r('peak', 4)} as peak,
  max(peak > 0 and (peak - balance)/peak >= 0.15) over (partition by account, epoch order by date rows between unbounded preceding and current row) as halted
from account_path""", "account_path"))
def t03(spark, sf):
    money = F.when(F.col("symbol") == "error", -10 * F.col("price")).when(F.col("symbol") == "purchase", 6 * F.col("price")).otherwise(0.0)
    events = SB.ticks(SB.read_table(spark, sf, "events")).select(
        F.col("user_id").cast("string").alias("account"), "ts", money.alias("net"), (F.col("symbol") == "signup").alias("reset"))
    # two chained streams: keyed state cannot follow an aggregation in one append query
    landing = scratch_path(spark, "daily-results")
    daily = SB.daily_results(events)
    SB.drain(daily, landing, f"{landing}-offsets")
    return rounded(SB.run_to_table(SS.latched_halt(spark.readStream.schema(daily.schema).parquet(landing)), "halts"), 4)


@query("t04_streamed_exits", sql(EXIT_SQL + "exits", "exits"))
def t04(spark, sf):
    # bars land in three batches; the state of each run carries into the next
    bars = inputs.bars(spark, sf)
    marked = materialize(indicators.blocked(bars, indicators.RSI_HALO, 0, indicators.add_rsi).select(
        "symbol", "date", "open", "high", "low", "close", S.flag(F.col("rsi") < 35).cast("boolean").alias("enter")))
    landing, out = scratch_path(spark, "bars-landing"), scratch_path(spark, "exits")
    year = F.year("date")
    for part_of in (year < 1997, (year >= 1997) & (year < 1999), year >= 1999):
        marked.filter(part_of).write.mode("append").parquet(landing)
        SB.drain(SS.position_exits(spark.readStream.schema(marked.schema).parquet(landing)), out, f"{out}-offsets")
    return show_exits(spark.read.schema(SS.EXIT_OUT).parquet(out).filter(F.col("reason") != SS.STALE))


@query("t05_ledger_upsert", sql(f"""
select p.symbol || '|' || cast(p.entry_date as varchar) as row_id, case when e.reason is null then 'OPEN' else 'CLOSED' end as action,
       e.reason, e.hold_days, {r('e.pnl_net')} as pnl_net
from pos p left join trades e on e.symbol = p.symbol and e.entry_date = p.entry_date""", "pos", "trades"))
def t05(spark, sf):
    both = materialize(inputs.exited(inputs.bars(spark, sf)))
    identity = F.concat_ws("|", "symbol", F.col("date").cast("string"))
    book, landing = scratch_path(spark, "ledger"), scratch_path(spark, "exits-landing")
    SU.write_ledger(ledger.opened(both).withColumn("row_id", identity), book)
    closed = ledger.with_pnl(exits.resolved(both).withColumn("trade_size", F.lit(RULES.trade_size)))
    rows = closed.withColumn("date", F.col("entry_date")).select(
        identity.alias("row_id"), "date", "symbol", "exit_date", *ledger.CLOSING, F.lit(None).cast("double").alias("balance_after"))
    rows = materialize(rows)
    rows.write.parquet(landing)
    stream = spark.readStream.schema(rows.schema).parquet(landing)
    SU.upsert(stream, book, f"{landing}-offsets")
    SU.merge_batch(rows, book)  # a repeated batch changes nothing
    done = SU.read_ledger(spark, book)
    return rounded(done.select("row_id", "action", "reason", "hold_days", "pnl_net"))


@query("t06_flow_stream", sql(f"""
select event_type as symbol, cast(ts as date) as date, {r('(2*sum(case when value > 50 then value else 0 end) - sum(value))/sum(value)')} as ofi
from events where cast(ts as date) in (select date from complete_days) group by 1, 2 having sum(value) > 0""", "complete_days"))
def t06(spark, sf):
    flow = SB.ticks(SB.read_table(spark, sf, "events")).select(
        "symbol", "ts", F.when(F.col("price") > 50, F.col("price")).otherwise(0.0).alias("taker"), F.col("price").alias("total"))
    return rounded(SB.run_to_table(SB.daily_flow(flow), "flow"))
