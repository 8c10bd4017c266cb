"""Aggregations, ledger, risk and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import compare, exits, flow, indicators, ledger, metrics, research, risk, sentiment, series, training
from ..params import FEATURES, RULES
from ..session import materialize
from . import inputs
from .q_indicators import full_features
from .q_positions import admitted
from .registry import query
from .sqlparts import d, part, r, sql


def rounded(df, digits=6, **special):
    """Round every double column."""
    return df.select(*[
        S.presented(c, special.get(c, digits)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes
    ])


def trades_of(spark, sf):
    return inputs.trades(inputs.bars(spark, sf))


STATS_SQL = f"""count(*) as n_trades, count(*) filter (win) as n_wins, count(*) filter (not win) as n_losses,
 {r('avg(cast(win as double))')} as win_rate, {r('coalesce(avg(pnl_net) filter (win), 0)')} as avg_win,
 {r('coalesce(avg(pnl_net) filter (not win), 0)')} as avg_loss, {r('avg(hold_days)')} as avg_hold_days"""
PF_SQL = ("case when abs(coalesce(sum(pnl_net) filter (pnl_net <= 0), 0)) > 0 then coalesce(sum(pnl_net) filter (pnl_net > 0), 0)"
          "/abs(sum(pnl_net) filter (pnl_net <= 0)) else cast('inf' as double) end")


@query("a01_trade_stats", sql(f"select {STATS_SQL} from trades", "trades"))
def a01(spark, sf):
    return rounded(trades_of(spark, sf).agg(*metrics.trade_stats()))


@query("a02_profit_factor", sql(f"select symbol, {r(PF_SQL)} as profit_factor from trades group by 1", "trades"))
def a02(spark, sf):
    return rounded(trades_of(spark, sf).groupBy("symbol").agg(metrics.profit_factor().alias("profit_factor")))


@query("a02_profit_factor_without_loss", sql("""
select symbol, cast('inf' as double) as profit_factor, count(*) as n from trades where pnl_net > 0 group by 1""", "trades"))
def a02_inf(spark, sf):
    winners = trades_of(spark, sf).filter("pnl_net > 0")
    return winners.groupBy("symbol").agg(metrics.profit_factor().alias("profit_factor"), F.count(F.lit(1)).alias("n"))


part("growth", ["equity"], """
select arg_min(balance, date) as start_balance, arg_max(balance, date) as end_balance,
       arg_max(balance, date)/arg_min(balance, date) - 1 as total_return, date_diff('day', min(date), max(date))/365.25::double as years
from equity
""")
part("falls", ["equity"], """
select date, balance, balance/lag(balance) over (order by date) - 1 as ret,
       balance/max(balance) over (order by date rows between unbounded preceding and current row) - 1 as fall
from equity
""")
part("sheet", ["growth", "falls"], """
select g.*, power(1 + total_return, 1/years) - 1 as cagr,
       (select case when stddev_samp(ret) > 0 then avg(ret)/stddev_samp(ret)*sqrt(252::double) else 0 end from falls) as sharpe,
       (select min(fall) from falls) as max_drawdown
from growth g
""")


def equity_of(spark, sf, scale=1.0):
    bars = inputs.bars(spark, sf)
    return ledger.equity_curve(inputs.trades(bars, scale), bars)


@query("a03_growth", sql(f"""
select {r('start_balance')} as start_balance, {r('end_balance')} as end_balance, {r('total_return', 9)} as total_return,
       {r('years')} as years, {r('cagr', 9)} as cagr from sheet""", "sheet"))
def a03(spark, sf):
    return rounded(equity_of(spark, sf).agg(*metrics.equity_growth()), total_return=9, cagr=9)


@query("a04_sharpe", sql(f"select {r('sharpe')} as sharpe from sheet", "sheet"))
def a04(spark, sf):
    moves = metrics.equity_returns(materialize(equity_of(spark, sf)))
    return rounded(moves.agg(metrics.sharpe().alias("sharpe")))


@query("a05_drawdown_calmar", sql(f"""
select {r('max_drawdown', 9)} as max_drawdown, {r('cagr/abs(max_drawdown)')} as calmar from sheet""", "sheet"))
def a05(spark, sf):
    sheet = metrics.equity_sheet(materialize(equity_of(spark, sf))).select("max_drawdown", "calmar")
    return rounded(sheet, max_drawdown=9)


@query("a06_by_reason", sql(f"select reason, count(*) as n, {r('sum(pnl_net)')} as net from trades group by 1", "trades"))
def a06(spark, sf):
    return rounded(metrics.by_reason(trades_of(spark, sf)))


@query("a07_by_symbol", sql(f"""
select u.symbol, count(t.symbol) as n, {r('avg(cast(t.win as double))*100')} as win_pct, {r('sum(t.pnl_net)')} as net
from (select symbol from bars union select n_name from nation where n_regionkey = 0) u
left join trades t on t.symbol = u.symbol group by 1""", "bars", "trades"))
def a07(spark, sf):
    bars = inputs.bars(spark, sf)
    # symbols of the universe that never traded are listed too
    idle = inputs.table(spark, sf, "nation").filter("n_regionkey = 0").select(F.col("n_name").alias("symbol"))
    return rounded(metrics.by_symbol(inputs.trades(bars), bars.select("symbol").union(idle)))


part("ledger_signals", ["cands"], """
select date, symbol, close, case when prob < 0.6 then 'PROB_TOO_LOW' when ofi <= 0 then 'OFI_NEGATIVE' else 'NONE' end as reject_reason
from cands
""")
part("gate_pos", ["ledger_signals", "bars"], """
select s.symbol, s.date as entry_date, s.close as entry_price, b.high as entry_high, b.rn as entry_rn, 0::double as signal_prob, 0::double as ofi,
       s.reject_reason
from ledger_signals s join bars b on b.symbol = s.symbol and b.date = s.date where s.reject_reason in ('NONE', 'OFI_NEGATIVE')
""")
from .sqlparts import exits_parts  # noqa: E402

exits_parts("q", "gate_pos")
part("gate_rows", ["qexits", "gate_pos"], """
select e.symbol, e.entry_date as date, case when p.reject_reason = 'NONE' then 'OFI_PASS' else 'OFI_BLOCKED' end as "group", e.reason,
       (e.exit_price - e.entry_price)/e.entry_price as pnl_pct
from qexits e join gate_pos p on p.symbol = e.symbol and p.entry_date = e.entry_date
""")
GATE_SQL = f"""
select "group", count(*) as n, {r("avg(case when reason = 'TP' then 1.0 else 0 end)*100")} as tp_pct,
  {r("avg(case when reason = 'SL' then 1.0 else 0 end)*100")} as sl_pct, {r("avg(case when reason = 'TRAIL_BE' then 1.0 else 0 end)*100")} as trail_pct,
  {r('avg(pnl_pct)', 9)} as mean_pnl_pct, {r("avg(case when reason = 'TP' then 1.0 else 0 end)")} as win_rate, count(*) < 30 as small_sample
from gate_rows group by 1"""


def gate_outcomes(spark, sf):
    """The entered signals' trades come from the ledger, the blocked ones are reconstructed."""
    bars = materialize(inputs.bars(spark, sf))
    cands = inputs.candidates(bars)
    reason = (F.when(F.col("prob") < RULES.signal_threshold, "PROB_TOO_LOW")
              .when(F.col("ofi") <= RULES.flow_gate, "OFI_NEGATIVE").otherwise("NONE"))
    signals = cands.select("date", "symbol", "close", reason.alias("reject_reason"))
    taken = signals.filter("reject_reason = 'NONE'").select(
        "symbol", F.col("date").alias("entry_date"), F.col("close").alias("entry_price"))
    book = exits.resolved(compare.reconstruct(taken, bars)).withColumnRenamed("entry_date", "date")
    return compare.gate_rows(signals, book, bars)


@query("a08_gate_comparison", sql(GATE_SQL, "gate_rows"))
def a08(spark, sf):
    return rounded(compare.gate_quality(gate_outcomes(spark, sf)), mean_pnl_pct=9)


SUMMARY_SQL = f"""count(*) as n, {r('sum(pnl_net)/10000')} as total_return, {r('avg(cast(pnl_net > 0 as double))')} as win_rate,
 {r(PF_SQL)} as profit_factor, {r('avg(pnl_net/10000)*100', 9)} as avg_pnl_pct, count(*) filter (reason = 'TP') as n_tp,
 count(*) filter (reason = 'SL') as n_sl, count(*) filter (starts_with(reason, 'TRAIL')) as n_trail,
 count(*) filter (starts_with(reason, 'MAX_HOLD')) as n_max_hold"""


@query("a09_realized_summary", sql(f"""
select {SUMMARY_SQL}, (select {r('min(fall)', 9)} from falls) as max_drawdown from trades""", "trades", "falls"))
def a09(spark, sf):
    bars = inputs.bars(spark, sf)
    trades = materialize(inputs.trades(bars))
    drawdown = metrics.max_drawdown(materialize(ledger.equity_curve(trades, bars)))
    # two single rows
    return rounded(metrics.summary(trades).crossJoin(drawdown), avg_pnl_pct=9, max_drawdown=9)


part("hold", ["bars"], """
select avg(last/first - 1) as buy_hold, count(*) as n_symbols
from (select arg_min(close, date) as first, arg_max(close, date) as last from bars group by symbol having count(*) >= 2)
""")


@query("a10_buy_and_hold", sql(f"select {r('buy_hold')} as buy_hold, n_symbols from hold", "hold"))
def a10(spark, sf):
    return rounded(metrics.buy_and_hold(inputs.bars(spark, sf)))


part("levels", [], """
select l_returnflag as symbol, date_trunc('month', l_shipdate) as ts, l_linestatus as side, l_quantity as size,
       row_number() over (partition by l_returnflag, date_trunc('month', l_shipdate), l_linestatus
         order by case when l_linestatus = 'O' then -l_extendedprice/l_quantity else l_extendedprice/l_quantity end, l_quantity) as level
from lineitem
""")


@query("a11_book_imbalance", sql(f"""
select symbol, cast(ts as date) as month, {r('''(coalesce(sum(size) filter (side = 'O'), 0) - coalesce(sum(size) filter (side = 'F'), 0))/sum(size)''', 9)} as ofi
from levels where level <= 20 group by 1, 2""", "levels"))
def a11(spark, sf):
    book = flow.book_imbalance(inputs.book(spark, sf))
    return book.select("symbol", F.to_date("ts").alias("month"), S.presented("ofi", 9).alias("ofi"))


@query("a12_flow_imbalance", sql(f"select symbol, date, {r('ofi', 9)} as ofi from flow", "flow"))
def a12(spark, sf):
    lines = inputs.table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("symbol"), F.to_date("l_shipdate").alias("date"), F.col("l_quantity").alias("total"),
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(0.0).alias("taker"))
    return flow.daily_flow(lines).select("symbol", "date", S.presented("ofi", 9).alias("ofi"))


part("trainable", ["features"], """
select *, row_number() over (partition by symbol order by date desc) as back from features where target is not null
""")
NUM = [c for c in FEATURES]


@query("a13_winsor_bounds", sql(
    "select symbol, feature, " + r("lo") + " as lo, " + r("hi") + " as hi from ("
    + " union all ".join(f"select symbol, '{c}' as feature, quantile_cont(coalesce(cast({c} as double), 0), 0.01) as lo, "
                         f"quantile_cont(coalesce(cast({c} as double), 0), 0.99) as hi from trainable where back <= 180 group by symbol" for c in NUM)
    + ") t", "trainable"))
def a13(spark, sf):
    window = training.training_window(full_features(spark, sf))
    return rounded(training.tall(training.winsor_bounds(window), "lo", "hi"))


@query("a14_scale", sql(
    "select symbol, feature, " + r("mean") + " as mean, " + r("std") + " as std from ("
    + " union all ".join(f"select symbol, '{c}' as feature, avg(coalesce(cast({c} as double), 0)) as mean, "
                         f"case when stddev_pop(coalesce(cast({c} as double), 0)) = 0 then 1 else stddev_pop(coalesce(cast({c} as double), 0)) end as std "
                         f"from trainable where back <= 180 group by symbol" for c in NUM) + ") t", "trainable"))
def a14(spark, sf):
    window = training.training_window(full_features(spark, sf))
    return rounded(training.tall(training.scale_stats(window), "mean", "std"))


@query("a15_holdout_accuracy", sql(f"""
select symbol, {r('avg(cast(cast(rsi < 50 as integer) = target as double))')} as accuracy, count(*) as n
from trainable where back <= 20 group by 1""", "trainable"))
def a15(spark, sf):
    held = training.split(training.training_window(full_features(spark, sf))).filter("holdout")
    guess = held.withColumn("prediction", (F.col("rsi") < 50).cast("int"))
    return rounded(guess.groupBy("symbol").agg(training.accuracy().alias("accuracy"), F.count(F.lit(1)).alias("n")))


@query("a16_class_weights", sql(f"""
select symbol, target, count(*) as n, {r('sum(count(*)) over (partition by symbol)/(2.0::double*count(*))')} as weight
from trainable where back <= 180 group by 1, 2""", "trainable"))
def a16(spark, sf):
    weights = training.class_weights(training.training_window(full_features(spark, sf)), ["symbol"])
    return rounded(weights)


@query("a17_fidelity", sql(f"""
select count(*) as n, count(*) filter (matches) as n_match, {r('avg(cast(matches as double))*100')} as match_pct from fidelity""", "fidelity"))
def a17(spark, sf):
    bars = inputs.bars(spark, sf)
    return rounded(compare.fidelity_summary(compare.fidelity(inputs.live_trades(inputs.trades(bars)), bars)))


@query("a17_mismatches", sql("""
select entry_date, symbol, recorded, reconstructed from fidelity where not matches""", "fidelity"))
def a17_mismatches(spark, sf):
    bars = inputs.bars(spark, sf)
    checked = compare.fidelity(inputs.live_trades(inputs.trades(bars)), bars)
    return checked.filter(~F.col("matches")).select("entry_date", "symbol", "recorded", "reconstructed")


@query("a18_window_bounds", sql("""
select min(entry_date) as first_date, max(entry_date) as last_date, count(*) filter (reason is not null) as n_closed,
       count(*) filter (reason is null) as n_open
from (select p.entry_date, e.reason from pos p left join exits e on e.symbol = p.symbol and e.entry_date = p.entry_date)""", "pos", "exits"))
def a18(spark, sf):
    closed = F.col("reason").isNotNull()
    return inputs.exited(inputs.bars(spark, sf)).agg(
        F.min("entry_date").alias("first_date"), F.max("entry_date").alias("last_date"),
        F.count_if(closed).alias("n_closed"), F.count_if(~closed).alias("n_open"))


@query("a19_small_sample", sql("""
select date_trunc('month', entry_date)::date as month, reason, count(*) as n, count(*) < 30 as small_sample from trades group by 1, 2""", "trades"))
def a19(spark, sf):
    counted = trades_of(spark, sf).groupBy(F.trunc("entry_date", "month").alias("month"), "reason").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("small_sample", metrics.small_sample(F.col("n")))


part("run_day", ["bars"], "select max(date) - 30 as run_date from bars")


@query("a20_run_summary", sql(f"""
select (select run_date from run_day) as run_date,
  (select count(*) from trades where exit_date = (select run_date from run_day) - 1) as n_exits,
  (select count(*) from pos where entry_date = (select run_date from run_day)) as n_entries,
  (select count(*) from pos p left join exits e on e.symbol = p.symbol and e.entry_date = p.entry_date
     where p.entry_date <= (select run_date from run_day) and coalesce(e.exit_date, date '9999-01-01') >= (select run_date from run_day)) as n_open,
  {r(f"{d(10000)} + (select coalesce(sum(pnl_net), 0) from trades where exit_date < (select run_date from run_day))")} as balance,
  (select {r('max(greatest(balance, 10000))')} from equity where date < (select run_date from run_day)) as peak""", "run_day", "trades", "pos", "exits", "equity"))
def a20(spark, sf):
    from . import reports

    bars = inputs.bars(spark, sf)
    positions = materialize(inputs.exited(bars).withColumn("trade_size", F.lit(RULES.trade_size)))
    day = bars.agg(F.date_sub(F.max("date"), 30).alias("run_date"))
    return rounded(reports.run_counts(positions, bars, day))


@query("a21_distinct_dates", sql("select distinct date from bars", "bars"))
def a21(spark, sf):
    return inputs.bars(spark, sf).select("date").distinct()


@query("a22_edge_vs_benchmark", sql(f"""
select {r('(select sum(pnl_net)/10000 from trades)')} as strategy, {r('buy_hold')} as buy_hold,
       {r('((select sum(pnl_net)/10000 from trades) - buy_hold)*100')} as edge_pp from hold""", "trades", "hold"))
def a22(spark, sf):
    from . import reports

    bars = inputs.bars(spark, sf)
    return rounded(reports.strategy_vs_hold(inputs.trades(bars), bars))


# ---- ledger and risk ----

@query("l01_trade_pnl", sql(f"""
select symbol, entry_date, {r('pnl_gross')} as pnl_gross, {r('fees')} as fees, {r('pnl_net')} as pnl_net, win from trades""", "trades"))
def l01(spark, sf):
    return rounded(trades_of(spark, sf).select("symbol", "entry_date", "pnl_gross", "fees", "pnl_net", "win"))


@query("l02_running_balance", sql(f"""
select exit_date, symbol, entry_date, {r(f'{d(10000)} + sum(pnl_net) over (order by exit_date, symbol, entry_date rows between unbounded preceding and current row)')} as balance_after
from trades""", "trades"))
def l02(spark, sf):
    return rounded(ledger.running_balance(trades_of(spark, sf)).select("exit_date", "symbol", "entry_date", "balance_after"))


@query("l03_equity", sql(f"select date, {r('balance')} as balance from equity", "equity"))
def l03(spark, sf):
    return rounded(equity_of(spark, sf))


part("dd", ["equity10"], """
select date, balance, greatest(max(balance) over (order by date rows between unbounded preceding and current row), 10000) as peak from equity10
""")
part("trips", ["dd"], "select *, (peak - balance)/peak as drawdown, (peak - balance)/peak >= 0.15 as tripped from dd")
part("resets", ["calendar"], "select min(date) as date from calendar group by year(date)")


@query("l04_drawdown", sql(f"""
select date, {r('balance')} as balance, {r('peak')} as peak, {r('drawdown', 9)} as drawdown, tripped from trips""", "trips"))
def l04(spark, sf):
    equity = materialize(equity_of(spark, sf, 10.0))
    return rounded(risk.with_drawdown(equity).select("date", "balance", "peak", "drawdown", "tripped"), drawdown=9)


@query("l05_latched_halt", sql("""
select date, epoch, max(tripped) over (partition by epoch order by date rows between unbounded preceding and current row) as halted
from (select t.*, cast(count(r.date) over (order by t.date rows between unbounded preceding and current row) as bigint) as epoch
      from trips t left join resets r on r.date = t.date)""", "trips", "resets"))
def l05(spark, sf):
    equity = materialize(equity_of(spark, sf, 10.0))
    resets = equity.groupBy(F.year("date")).agg(F.min("date").alias("date")).select("date")
    return risk.latched_halt(equity, resets).select("date", "epoch", "halted")


@query("l06_open_to_closed", sql(f"""
select p.symbol, p.entry_date as date, case when e.reason is null then 'OPEN' else 'CLOSED' end as action, e.reason, e.hold_days,
       {r('e.pnl_net')} as pnl_net, case when e.reason is null then '' end as stop_order_id
from pos p left join trades e on e.symbol = p.symbol and e.entry_date = p.entry_date""", "pos", "trades"))
def l06(spark, sf):
    both = materialize(inputs.exited(inputs.bars(spark, sf)))
    identity = F.concat_ws("|", "symbol", F.col("date").cast("string"))
    book = ledger.opened(both).withColumn("row_id", identity)
    closed = ledger.with_pnl(exits.resolved(both).withColumn("trade_size", F.lit(RULES.trade_size)))
    closed = closed.withColumn("date", F.col("entry_date")).withColumn("row_id", identity).withColumn(
        "balance_after", F.lit(None).cast("double"))
    return rounded(ledger.close_trades(book, closed).select("symbol", "date", "action", "reason", "hold_days", "pnl_net", "stop_order_id"))


@query("l07_row_ids", sql("""
select 'T' || lpad(cast(row_number() over (order by entry_date, symbol) as varchar), 4, '0') as row_id, entry_date, symbol from pos""", "pos"))
def l07(spark, sf):
    positions = inputs.rsi_positions(inputs.bars(spark, sf)).select("entry_date", "symbol")
    return ledger.numbered(positions, ["entry_date", "symbol"])


@query("l08_missing_size", sql(f"""
select symbol, entry_date, {r(f"case when day(entry_date) = 1 then {d(9000)}*{d(0.01)}/3 else {d(50)} end")} as trade_size from pos""", "pos"))
def l08(spark, sf):
    size = F.when(F.dayofmonth("entry_date") != 1, F.lit(50.0))
    positions = inputs.rsi_positions(inputs.bars(spark, sf)).withColumn("trade_size", size)
    return rounded(ledger.sized(positions, F.lit(9000.0)).select("symbol", "entry_date", "trade_size"))


# ---- reports ----

@query("r01_metrics_sheet", sql(f"""
select {r('start_balance')} as start_balance, {r('end_balance')} as end_balance, {r('total_return', 9)} as total_return, {r('cagr', 9)} as cagr,
  {r('sharpe')} as sharpe, {r('max_drawdown', 9)} as max_drawdown, {r('cagr/abs(max_drawdown)')} as calmar, t.*
from sheet, (select {STATS_SQL}, {r(PF_SQL)} as profit_factor from trades) t""", "sheet", "trades"))
def r01(spark, sf):
    from . import reports

    bars = inputs.bars(spark, sf)
    return rounded(reports.metrics_sheet(materialize(inputs.trades(bars)), bars), total_return=9, cagr=9, max_drawdown=9)


@query("r02_breakdown", sql(f"""
select 'reason' as dimension, reason as value, count(*) as n, {r('avg(cast(win as double))*100')} as win_pct, {r('sum(pnl_net)')} as net from trades group by 2
union all select 'symbol', symbol, count(*), {r('avg(cast(win as double))*100')}, {r('sum(pnl_net)')} from trades group by 2""", "trades"))
def r02(spark, sf):
    from . import reports

    return rounded(reports.breakdown(trades_of(spark, sf)))


@query("r03_gate_quality", sql(f"""
select date, symbol, "group", reason, {r('pnl_pct', 9)} as pnl_pct, reason = 'TP' as win from gate_rows""", "gate_rows"))
def r03(spark, sf):
    return rounded(gate_outcomes(spark, sf), pnl_pct=9)


@query("r04_fidelity", sql(f"""
select recorded, reconstructed, count(*) as n, {r('avg(cast(matches as double))*100')} as match_pct from fidelity group by 1, 2""", "fidelity"))
def r04(spark, sf):
    bars = inputs.bars(spark, sf)
    checked = compare.fidelity(inputs.live_trades(inputs.trades(bars)), bars)
    return rounded(checked.groupBy("recorded", "reconstructed").agg(
        F.count(F.lit(1)).alias("n"), (F.avg(F.col("matches").cast("double")) * 100).alias("match_pct")))


part("bounds", ["live"], "select min(entry_date) as a, max(entry_date) as b from live")


part("sides", ["live", "trades", "bounds"], """
select 'realized' as side, exit_date, pnl_net, win, reason from live
union all select 'predicted', exit_date, pnl_net, win, reason from trades where entry_date between (select a from bounds) and (select b from bounds)
union all select 'predicted_same_keys', exit_date, pnl_net, win, reason from trades t
  where exists (select 1 from live l where l.symbol = t.symbol and l.entry_date = t.entry_date)""")
part("side_days", ["sides"], """
select side, exit_date, 10000 + sum(sum(pnl_net)) over (partition by side order by exit_date) as balance from sides group by 1, 2""")
part("side_falls", ["side_days"], """
select side, balance, greatest(10000, max(balance) over (partition by side order by exit_date)) as peak from side_days""")


@query("r05_realized_vs_predicted", sql(f"""
select side, {SUMMARY_SQL}, (select {r('-max((peak - balance)/peak)', 9)} from side_falls f where f.side = sides.side) as max_drawdown
from sides group by side""", "sides", "side_falls"))
def r05(spark, sf):
    from . import reports

    trades = materialize(inputs.trades(inputs.bars(spark, sf)))
    return rounded(reports.realized_vs_predicted(inputs.live_trades(trades), trades), avg_pnl_pct=9, max_drawdown=9)


@query("r06_strategy_vs_hold", sql(f"""
select a as window_start, b as window_end, {r('(select sum(pnl_net)/10000 from live)')} as strategy, {r('h.buy_hold')} as buy_hold,
  {r('((select sum(pnl_net)/10000 from live) - h.buy_hold)*100')} as edge_pp
from bounds, (select avg(last/first - 1) as buy_hold from (
   select arg_min(close, date) as first, arg_max(close, date) as last from bars, bounds where date between a and b group by symbol having count(*) >= 2)) h""",
                                    "bounds", "live", "bars"))
def r06(spark, sf):
    from . import reports

    bars = inputs.bars(spark, sf)
    live = materialize(inputs.live_trades(inputs.trades(bars)))
    return rounded(reports.live_vs_hold(live, bars))


@query("r07_run_summary", sql(f"""
select date, cast(value as integer) as value,
  case when value <= 25 then 'Extreme Fear' when value <= 49 then 'Fear' when value <= 74 then 'Greed' when value is not null then 'Extreme Greed' end as label,
  {r('week', 6)} as benchmark_week, case when week*100 > 5 then 'leading' when week is not null then 'neutral' end as benchmark_label,
  coalesce(n_signals, 0) as n_signals, coalesce(n_fired, 0) as n_fired
from (select b.date, b.close/lag(b.close, 7) over (order by b.date) - 1 as week from bars b where b.symbol = 'N')
full join sentiment using (date)
full join (select date, count(*) as n_signals, count(*) filter (prob >= 0.6 and ofi > 0) as n_fired from cands group by 1) using (date)""", "bars", "sentiment", "cands"))
def r07(spark, sf):
    from . import reports

    return rounded(reports.day_notes(inputs.bars(spark, sf), inputs.sentiment(spark, sf), benchmark="N"))
