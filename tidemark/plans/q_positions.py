"""Joins of positions with bars, exits and entry admission."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import admission, exits, flow, ledger, sentiment, series
from ..params import RULES
from ..session import materialize, scratch_path
from ..sources import bucketed
from . import inputs
from .registry import SQL, query
from .sqlparts import d, exits_parts, part, r, sql

EXIT_COLUMNS = ["exit_price", "pnl_pct", "entry_price"]
EXIT_SQL = (f"select symbol, entry_date, exit_date, reason, hold_days, {r('exit_price')} as exit_price, "
            f"{r('pnl_pct', 9)} as pnl_pct, {r('entry_price')} as entry_price from ")


def show_exits(df):
    return exits.resolved(df).select(
        "symbol", "entry_date", "exit_date", "reason", "hold_days",
        S.presented("exit_price", 6).alias("exit_price"), S.presented("pnl_pct", 9).alias("pnl_pct"),
        S.presented("entry_price", 6).alias("entry_price"),
    )


# ---- joins ----

@query("j01_sentiment_on_bars", sql("select symbol, date, fg from fgs", "fgs"))
def j01(spark, sf):
    return sentiment.align(inputs.bars(spark, sf), inputs.sentiment(spark, sf)).select("symbol", "date", "fg")


part("logged_trades", ["exits"], """
select *, entry_date as date, row_number() over (partition by symbol, entry_date order by exit_date) as copy from exits
""")
part("entry_signals", ["bars"], """
select date, symbol, close, (vi % 100)/100.0::double as prob, (2.0::double*taker - vi)/vi as ofi from bars
where (vi % 100)/100.0::double >= 0.6
""")


@query("j02_signal_with_trade", sql(f"""
select s.date, s.symbol, t.reason, {r('(t.exit_price - t.entry_price)/t.entry_price', 9)} as pnl_pct
from entry_signals s join exits t on t.entry_date = s.date and t.symbol = s.symbol""", "entry_signals", "exits"))
def j02(spark, sf):
    from ..operators import compare

    bars = inputs.bars(spark, sf)
    trades = exits.resolved(inputs.exited(bars)).withColumnRenamed("entry_date", "date")
    matched = compare.first_trade(inputs.entry_signals(bars), trades)
    return matched.select("date", "symbol", "reason", S.presented("pnl_pct", 9).alias("pnl_pct"))


@query("j02_signal_without_trade", sql("""
select s.date, s.symbol from entry_signals s
where not exists (select 1 from exits t where t.entry_date = s.date and t.symbol = s.symbol)""", "entry_signals", "exits"))
def j02_missing(spark, sf):
    from ..operators import compare

    bars = inputs.bars(spark, sf)
    trades = exits.resolved(inputs.exited(bars)).withColumnRenamed("entry_date", "date")
    return compare.without_trade(inputs.entry_signals(bars), trades).select("date", "symbol")


@query("j03_position_bars", sql(f"""
select symbol, entry_date, cast(k as integer) as k, date, {r('open')} as open, {r('high')} as high, {r('low')} as low, {r('close')} as close
from path where k <= 5""", "path"))
def j03(spark, sf):
    bars = inputs.bars(spark, sf)
    joined = exits.at_entry(inputs.rsi_positions(bars), exits.with_path(bars))
    rows = exits.position_bars(joined)
    return rows.select("symbol", "entry_date", "k", "date", *[S.presented(c, 6).alias(c) for c in ("open", "high", "low", "close")])


part("held", ["pos"], """
select *, row_number() over (partition by symbol order by entry_date) as n, entry_date + cast(3 as integer) as run_date from pos
""")
part("checked", ["held", "bars"], f"""
select h.*, b.open, b.high, b.low, b.close, b.date as check_date, date_diff('day', h.entry_date, b.date) as hold,
  exists (select 1 from bars e where e.symbol = h.symbol and e.date >= h.entry_date and e.date < b.date
          and e.high >= h.entry_price*(1 + {d(0.015)})) as armed
from held h join bars b on b.symbol = h.symbol and b.date = h.run_date - 1
""")


def _held(bars):
    """Every position looked at on the third day after its entry."""
    return inputs.rsi_positions(bars).withColumn("run_date", F.date_add("entry_date", 3)).withColumn(
        "row_id", F.concat_ws("|", "symbol", F.col("entry_date").cast("string"))
    )


@query("j04_check_bar", sql(f"""
select symbol, entry_date, check_date, {r('close')} as close from checked""", "checked"))
def j04(spark, sf):
    bars = inputs.bars(spark, sf)
    held = _held(bars).withColumn("check_date", F.date_sub("run_date", 1))
    bar = bars.select("symbol", F.col("date").alias("check_date"), "close")
    return held.join(bar, ["symbol", "check_date"]).select(
        "symbol", "entry_date", "check_date", S.presented("close", 6).alias("close"))


@query("j04_skipped", sql("""
select symbol, entry_date from (
  select p.symbol, p.entry_date, entry_date + 3 as run_date from bpos p) h
where not exists (select 1 from bbars b where b.symbol = h.symbol and b.date = h.run_date - 1)""", "bbars", "bpos"))
def j04_skipped(spark, sf):
    bars = inputs.business_bars(spark, sf)
    return exits.skipped(_held(bars), bars, F.col("run_date")).select("symbol", "entry_date")


@query("j05_armed_before_check", sql("select symbol, entry_date, armed from checked", "checked"))
def j05(spark, sf):
    bars = materialize(inputs.bars(spark, sf))
    return exits.check_day(_held(bars), bars, F.col("run_date")).select("symbol", "entry_date", "armed")


@query("j06_on_live_keys", sql("""
select t.symbol, t.entry_date, t.reason from trades t
where exists (select 1 from live l where l.entry_date = t.entry_date and l.symbol = t.symbol)""", "trades", "live"))
def j06(spark, sf):
    trades = materialize(inputs.trades(inputs.bars(spark, sf)))
    keys = inputs.live_trades(trades).select("entry_date", "symbol")
    return trades.join(keys, ["entry_date", "symbol"], "left_semi").select("symbol", "entry_date", "reason")


@query("j07_still_active", sql("""
select p.symbol, p.entry_date from pos p
where not exists (select 1 from exits e where e.symbol = p.symbol and e.entry_date = p.entry_date)""", "pos", "exits"))
def j07(spark, sf):
    positions = materialize(inputs.exited(inputs.bars(spark, sf)))
    closed = exits.resolved(positions).select("symbol", "entry_date")
    return positions.select("symbol", "entry_date").join(closed, ["symbol", "entry_date"], "left_anti")


@query("j08_flow_at_entry", sql(f"""
select p.symbol, p.entry_date, {r('coalesce(f.ofi, 0.0)', 9)} as ofi
from pos p left join (select * from flow where isodow(date) <= 5) f on f.symbol = p.symbol and f.date = p.entry_date""",
                               "pos", "flow"))
def j08(spark, sf):
    bars = inputs.bars(spark, sf)
    published = inputs.flow(bars).filter(F.weekday("date") < 5)
    positions = inputs.rsi_positions(bars).withColumn("date", F.col("entry_date"))
    return flow.with_flow(positions, published).select("symbol", "entry_date", S.presented("ofi", 9).alias("ofi"))


part("fidelity", ["live", "exits", "bars"], """
select l.symbol, l.entry_date, l.reason as recorded, coalesce(e.reason, 'NO_DATA') as reconstructed,
       l.reason = coalesce(e.reason, 'NO_DATA') as matches
from live l left join exits e on e.symbol = l.symbol and e.entry_date = l.entry_date
""")


@query("j09_recorded_vs_reconstructed", sql("select * from fidelity", "fidelity"))
def j09(spark, sf):
    from ..operators import compare

    bars = inputs.bars(spark, sf)
    recorded = inputs.live_trades(inputs.trades(bars))
    return compare.fidelity(recorded, bars).select("symbol", "entry_date", "recorded", "reconstructed", "matches")


@query("j10_ledger_merge", sql(f"""
select 'T' || lpad(cast(row_number() over (order by p.entry_date, p.symbol) as varchar), 4, '0') as row_id, p.entry_date as date, p.symbol,
       case when e.reason is null then 'OPEN' else 'CLOSED' end as action, {r('e.exit_price')} as exit_price,
       {r('e.pnl_net')} as pnl_net, e.reason, e.hold_days, e.win
from pos p left join trades e on e.symbol = p.symbol and e.entry_date = p.entry_date""", "pos", "trades"))
def j10(spark, sf):
    both = materialize(inputs.exited(inputs.bars(spark, sf)))
    book = ledger.numbered(ledger.opened(both), ["date", "symbol"])
    closed = ledger.with_pnl(exits.resolved(both).withColumn("trade_size", F.lit(RULES.trade_size))).select(
        F.lit("").alias("row_id"), F.col("entry_date").alias("date"), "symbol", "exit_date", "exit_price", "pnl_gross",
        "pnl_net", "fees", "reason", "hold_days", "win", F.lit(None).cast("double").alias("balance_after"),
    )
    merged = ledger.close_trades(book, closed)
    return merged.select("row_id", "date", "symbol", "action", S.presented("exit_price", 6).alias("exit_price"),
                         S.presented("pnl_net", 6).alias("pnl_net"), "reason", "hold_days", "win")


part("resting", ["pos"], """
select *, case when day(entry_date) = 1 then '' when day(entry_date) = 2 then 'FLATTEN_FAILED'
               else symbol || '-' || cast(entry_date as varchar) end as stop_order_id from pos
""")
part("order_status", ["resting"], f"""
select stop_order_id, case when day(entry_date) <= 15 then 'closed' else 'open' end as status,
       case when isodow(entry_date) <> 1 then entry_price * {d(0.985)} end as average
from resting where day(entry_date) <> 20
""")


@query("j11_stop_reconciliation", sql(f"""
select w.symbol, w.entry_date, coalesce(s.status = 'closed', false) as closed_by_stop,
       case when s.status = 'closed' then 'SL' end as reason,
       case when s.status = 'closed' then {r(f'coalesce(s.average, w.entry_price*(1 - {d(0.01)}))')} end as exit_price,
       case when s.status = 'closed' then w.entry_date + 1 end as exit_date,
       case when s.status = 'closed' then 1 end as hold_days
from resting w left join order_status s on s.stop_order_id = w.stop_order_id and w.stop_order_id not in ('', 'FLATTEN_FAILED')
""", "resting", "order_status"))
def j11(spark, sf):
    day = F.dayofmonth("entry_date")
    identity = F.concat_ws("-", "symbol", F.col("entry_date").cast("string"))
    order_id = F.when(day == 1, "").when(day == 2, "FLATTEN_FAILED").otherwise(identity)
    positions = materialize(inputs.rsi_positions(inputs.bars(spark, sf)).withColumn("stop_order_id", order_id))
    # some lookups fail (no row), some stops still rest, some fills have no average price
    status = positions.filter(day != 20).select(
        "stop_order_id", F.when(day <= 15, "closed").otherwise("open").alias("status"),
        F.when(F.weekday("entry_date") != 0, F.col("entry_price") * 0.985).alias("average"),
    )
    done = ledger.reconcile(positions, status, F.date_add("entry_date", 1))
    return done.select("symbol", "entry_date", "closed_by_stop", "reason",
                       S.presented("exit_price", 6).alias("exit_price"), "exit_date", "hold_days")


@query("j12_entry_bar_high", sql(f"select symbol, entry_date, {r('entry_high')} as entry_high from pos", "pos"))
def j12(spark, sf):
    bars = inputs.bars(spark, sf)
    high = bars.select("symbol", F.col("date").alias("entry_date"), F.col("high").alias("entry_high"))
    joined = inputs.rsi_positions(bars).join(high, ["symbol", "entry_date"])
    return joined.select("symbol", "entry_date", S.presented("entry_high", 6).alias("entry_high"))


# ---- exits ----

@query("e01_first_exit", sql(EXIT_SQL + "exits", "exits"))
def e01(spark, sf):
    bars = inputs.bars(spark, sf)
    return show_exits(exits.first_exit(exits.at_entry(inputs.rsi_positions(bars), exits.with_path(bars))))


part("brsi_delta", ["bbars"], "select *, close - lag(close) over (partition by symbol order by date) as delta from bbars")
part("bpos", ["brsi_delta"], """
select symbol, date as entry_date, close as entry_price, high as entry_high, rn as entry_rn,
       (vi % 100)/100.0::double as signal_prob, (2.0::double*taker - vi)/vi as ofi
from (select *, avg(greatest(delta, 0)) filter (delta is not null) over w as ag, avg(greatest(-delta, 0)) filter (delta is not null) over w as al,
             count(delta) over w as c from brsi_delta
      window w as (partition by symbol order by date rows between 13 preceding and current row))
where c = 14 and 100 - 100/(1 + ag/nullif(al, 0)) < 35
""")
exits_parts("b", "bpos", "bbars")


@query("e01_first_exit_with_gaps", sql(EXIT_SQL + "bexits", "bexits"))
def e01_gaps(spark, sf):
    return show_exits(inputs.exited(inputs.business_bars(spark, sf)))


exits_parts("g", "pos", "bars", plain=f"least(entry_price*(1 - {d(0.01)}), open)")


@query("e01_gap_aware_stop", sql(EXIT_SQL + "gexits", "gexits"))
def e01_gap(spark, sf):
    return show_exits(exits.first_exit(inputs.placed(inputs.bars(spark, sf)), replace(RULES, gap_aware_stop=True)))


@query("e02_daily_check", sql(f"""
select symbol, entry_date, check_date, armed,
  case when high >= entry_price*(1+{d(0.03)}) then 'TP'
       when low <= case when armed then entry_price*(1+{d(0.015)}) else entry_price*(1-{d(0.01)}) end
            then case when armed then 'TRAIL_BE' else 'SL' end
       when hold >= 5 then 'MAX_HOLD_' || hold || 'd' end as reason
from checked5""", "checked5"))
def e02(spark, sf):
    bars = materialize(inputs.bars(spark, sf))
    held = _held(bars).withColumn("run_date", F.date_add("entry_date", 6))
    done = exits.check_day(held, bars, F.col("run_date"))
    return done.select("symbol", "entry_date", F.date_sub("run_date", 1).alias("check_date"), "armed",
                       exits.reason_text(F.col("reason"), F.col("hold_days")).alias("reason"))


part("checked5", ["pos", "bars"], f"""
select h.*, b.open, b.high, b.low, b.close, b.date as check_date, date_diff('day', h.entry_date, b.date) as hold,
  exists (select 1 from bars e where e.symbol = h.symbol and e.date >= h.entry_date and e.date < b.date
          and e.high >= h.entry_price*(1 + {d(0.015)})) as armed
from pos h join bars b on b.symbol = h.symbol and b.date = h.entry_date + 5
""")


@query("e03_seeded_arm", sql(f"select symbol, entry_date, entry_high >= entry_price*(1 + {d(0.015)}) as seeded from pos", "pos"))
def e03(spark, sf):
    placed = inputs.placed(inputs.bars(spark, sf))
    seeded = F.col("entry_high") >= exits.levels(F.col("entry_price"))["trigger"]
    return placed.select("symbol", "entry_date", seeded.alias("seeded"))


ADMIT_SQL = """
select c.date, c.symbol, c.prob, c.ofi, c.in_position, d.n_open, d.halted, d.balance, d.balance*0.01::double/3 as trade_size,
  sum(case when not d.halted and not c.in_position and c.prob >= 0.6 and c.ofi > 0 and d.balance*0.01::double/3 >= 15 then 1 else 0 end)
    over (partition by c.date order by c.prob desc, c.symbol rows between unbounded preceding and 1 preceding) as entered
from cands c join daystate d using (date)
"""
part("walked", ["cands", "daystate"], ADMIT_SQL)
part("walked_small", ["cands", "daystate"], ADMIT_SQL.replace("d.balance*0.01", "1000*0.01"))
REASON_SQL = """
select date, symbol, prob, ofi, halted,
  case when halted then 'KILL_SWITCH_HALTED' when n_open + coalesce(entered, 0) >= 3 then 'MAX_POSITIONS'
       when in_position then 'ALREADY_IN_POS' when prob < 0.6 then 'PROB_TOO_LOW_' || printf('%.4f', prob)
       when ofi <= 0 then 'OFI_NEGATIVE_' || printf('%+.4f', ofi) when trade_size < 15 then 'MIN_ORDER_SIZE'
       else 'NONE' end as reject_reason
from {walked}
qualify reject_reason <> 'MAX_POSITIONS'
  or row_number() over (partition by date, reject_reason order by prob desc, symbol) = 1
"""
part("logged", ["walked"], REASON_SQL.format(walked="walked"))
part("logged_small", ["walked_small"], REASON_SQL.format(walked="walked_small"))


def admitted(bars, rules=RULES, balance=None):
    cands = materialize(inputs.candidates(bars))
    days = inputs.day_state(cands)
    if balance is not None:
        days = days.withColumn("balance", F.lit(float(balance)))
    return admission.admit(cands, days, rules)


@query("e04_reject_reasons", sql("select date, symbol, prob, reject_reason, reject_reason = 'NONE' as signal_fired from logged", "logged"))
def e04(spark, sf):
    return admitted(inputs.bars(spark, sf)).select("date", "symbol", "prob", "reject_reason", "signal_fired")


@query("e05_capacity", sql("""
select regexp_replace(reject_reason, '_[+-]?[0-9.]+$', '') as code, count(*) as n, count(distinct date) as days from logged group by 1""", "logged"))
def e05(spark, sf):
    return admitted(inputs.bars(spark, sf)).groupBy(S.reason_code(F.col("reject_reason")).alias("code")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("date").alias("days"))


@query("e06_min_order_size", sql("""
select regexp_replace(reject_reason, '_[+-]?[0-9.]+$', '') as code, count(*) as n from logged_small group by 1""", "logged_small"))
def e06(spark, sf):
    small = admitted(inputs.bars(spark, sf), balance=1000)
    return small.groupBy(S.reason_code(F.col("reject_reason")).alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query("e07_planned_levels", sql(f"""
select symbol, entry_date, {r(f'entry_price*(1+{d(0.03)})')} as target, {r(f'entry_price*(1-{d(0.01)})')} as stop,
       {r(f'entry_price*(1+{d(0.015)})')} as trigger from pos""", "pos"))
def e07(spark, sf):
    planned = inputs.rsi_positions(inputs.bars(spark, sf)).select(
        "symbol", "entry_date", *admission.planned_levels(F.col("entry_price")))
    return planned.select("symbol", "entry_date", *[S.presented(c, 6).alias(c) for c in ("target", "stop", "trigger")])


part("final_closed", ["pos", "exits", "bars"], """
select p.symbol, p.entry_date, p.entry_price, l.close as exit_price, (select max(date) from bars) as exit_date, 'FINAL_CLOSE' as reason
from pos p join (select symbol, arg_max(close, date) as close from bars group by 1) l using (symbol)
where not exists (select 1 from exits e where e.symbol = p.symbol and e.entry_date = p.entry_date)
""")


@query("e08_final_close", sql(f"""
select symbol, entry_date, exit_date, reason, {r('exit_price')} as exit_price, {r('(exit_price - entry_price)/entry_price', 9)} as pnl_pct,
       cast(date_diff('day', entry_date, exit_date) as integer) as hold_days from final_closed""", "final_closed"))
def e08(spark, sf):
    bars = inputs.bars(spark, sf)
    left = exits.unresolved(inputs.exited(bars))
    done = exits.final_close(left, bars)
    return done.select("symbol", "entry_date", "exit_date", "reason", S.presented("exit_price", 6).alias("exit_price"),
                       S.presented("pnl_pct", 9).alias("pnl_pct"), "hold_days")


@query("e09_unrealised", sql(f"""
select symbol, entry_date, {r('(close - entry_price)/entry_price', 9)} as unrealised from checked
where not (high >= entry_price*(1+{d(0.03)}) or low <= case when armed then entry_price*(1+{d(0.015)}) else entry_price*(1-{d(0.01)}) end)""",
                            "checked"))
def e09(spark, sf):
    bars = materialize(inputs.bars(spark, sf))
    held = exits.check_day(_held(bars), bars, F.col("run_date")).filter(F.col("reason").isNull())
    return held.select("symbol", "entry_date", S.presented("unrealised", 9).alias("unrealised"))


# ---- joins where the rows lie ----


def kept(df, name, keys):
    """A table in buckets of ``keys``, under a name of this run."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    return bucketed.save(df, path.rsplit("/", 1)[1].replace("-", "_"), keys, buckets(spark), path)


def buckets(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query("j02_signal_with_trade_buckets", lambda: SQL["j02_signal_with_trade"]())
def j02_buckets(spark, sf):
    from ..operators import compare

    bars = materialize(inputs.bars(spark, sf))
    trades = kept(exits.resolved(inputs.exited(bars)).drop("path").withColumnRenamed("entry_date", "date"), "trades", ["symbol", "date"])
    signals = kept(inputs.entry_signals(bars), "signals", ["symbol", "date"])
    matched = compare.first_trade(signals, trades)
    return matched.select("date", "symbol", "reason", S.presented("pnl_pct", 9).alias("pnl_pct"))


@query("j06_on_live_keys_buckets", lambda: SQL["j06_on_live_keys"]())
def j06_buckets(spark, sf):
    from ..operators import compare

    trades = materialize(inputs.trades(inputs.bars(spark, sf)).drop("path"))
    keys = ["symbol", "entry_date"]
    live = kept(inputs.live_trades(trades), "live", keys)
    return compare.on_keys(kept(trades, "replayed", keys), live).select("symbol", "entry_date", "reason")


@query("j09_fidelity_buckets", lambda: SQL["j09_recorded_vs_reconstructed"]())
def j09_buckets(spark, sf):
    from ..operators import compare

    bars = materialize(inputs.bars(spark, sf))
    recorded = kept(inputs.live_trades(inputs.trades(bars)).drop("path"), "recorded", ["symbol", "entry_date"])
    paths = kept(exits.with_path(bars), "paths", ["symbol", "date"])
    return compare.fidelity(recorded, paths).select("symbol", "entry_date", "recorded", "reconstructed", "matches")


@query("s11_results_side_by_side", sql("""
select symbol, entry_date, reason as base, case when ofi > 0 then reason end as other from trades""", "trades"))
def s11_buckets(spark, sf):
    trades = materialize(inputs.trades(inputs.bars(spark, sf)).drop("path"))
    keys, path = ["symbol", "entry_date"], scratch_path(spark, "results")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    for gate in (False, True, False):  # a rerun replaces its own configuration only
        bucketed.replace_results(trades.filter("ofi > 0") if gate else trades, name, "venue", gate, keys, buckets(spark), path)
    return bucketed.side_by_side(name, spark, "venue", "venue_ofi", keys, "reason")
