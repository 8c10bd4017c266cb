"""Sources and sinks, filters, scalar functions, sorts and sets."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from .. import schemas
from ..functions import scalars as S
from ..operators import admission, compare, exits, flow, indicators, ledger, series, training
from ..params import FEATURES, RULES
from ..session import materialize, scratch_path
from ..sources import logs, market, sinks, state
from . import inputs
from .q_indicators import INT_FEATURES, FLOAT_FEATURES, full_features, show
from .q_positions import admitted
from .q_results import rounded
from .registry import query
from .sqlparts import d, part, r, sql

OHLCV = ["open", "high", "low", "close", "volume"]
OHLCV_SQL = ", ".join(f"{r(c)} as {c}" for c in OHLCV)


def raw_klines(spark, sf):
    """Positional text rows as an exchange returns them. Business days of the last copy carry a changed
    volume, Sundays have a zero volume, month starts lack a close and month ends have an empty low."""
    bars = inputs.bars(spark, sf)
    ms = F.unix_millis(F.col("date").cast("timestamp"))
    close = F.when(F.dayofmonth("date") == 1, F.lit("0")).otherwise(F.col("close").cast("string"))
    low = F.when(F.dayofmonth("date") == 28, F.lit("")).otherwise(F.col("low").cast("string"))
    volume = F.when(F.weekday("date") == 6, 0.0).otherwise(F.col("volume")) + F.col("ingest_seq") - 1
    copies = bars.withColumn("ingest_seq", F.explode(F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))))
    none = F.lit("0")
    cells = F.array(
        ms.cast("string"), F.col("open").cast("string"), F.col("high").cast("string"), low, close, volume.cast("string"),
        none, none, none, F.col("taker").cast("double").cast("string"), none, none,
    )
    return copies.select("symbol", "ingest_seq", cells.alias("k"))


part("klines", ["bars"], """
select symbol, date, seq, open, high, case when day(date) = 28 then null else low end as low,
       case when day(date) = 1 then 0 else close end as close,
       case when isodow(date) = 7 then 0 else volume end + seq - 1 as volume, cast(taker as double) as taker
from bars, (values (1), (2)) t(seq)
""")


@query("s01_bars_from_klines", sql(f"""
select symbol, date, {OHLCV_SQL} from klines where low is not null and close > 0""", "klines"))
def s01(spark, sf):
    return show(market.bars_from_klines(raw_klines(spark, sf), dedup=False), *OHLCV)


@query("s02_dedup_klines", sql(f"""
select symbol, date, {OHLCV_SQL} from klines where seq = 1 and low is not null and close > 0""", "klines"))
def s02(spark, sf):
    return show(market.bars_from_klines(raw_klines(spark, sf)), *OHLCV)


def sentiment_payloads(spark, sf):
    """One JSON document per month with string cells; the second copy repeats the month with other values
    on business days, one document is broken."""
    days = inputs.sentiment(spark, sf).withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2))))
    stamp = F.unix_timestamp(F.col("date").cast("timestamp")).cast("string")
    value = F.when(F.col("seq") == 1, F.lit(7)).otherwise(F.col("value")).cast("string")
    entry = F.struct(F.col("date").alias("d"), stamp.alias("timestamp"), value.alias("value"))
    month = F.trunc("date", "month")
    # at most 31 days a month
    docs = days.groupBy(month.alias("month"), "seq").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    cut = F.transform("e", lambda x: F.struct(x["timestamp"].alias("timestamp"), x["value"].alias("value")))
    payload = F.to_json(F.struct(cut.alias("data")))
    broken = (F.col("seq") == 2) & (F.month("month") == 7)
    return docs.select(
        (F.months_between("month", F.lit("1990-01-01")) * 2 + F.col("seq")).cast("bigint").alias("payload_seq"),
        F.when(broken, F.substring(payload, 1, 20)).otherwise(payload).alias("payload"),
    )


@query("s03_sentiment_json", sql("""
select date, case when month(date) = 7 then 7 else value end as value from sentiment""", "sentiment"))
def s03(spark, sf):
    return market.parse_sentiment(sentiment_payloads(spark, sf))


@query("s04_kline_flow", sql(f"""
select symbol, date, {r('(2*taker - volume)/volume', 9)} as ofi from klines where seq = 1 and volume > 0""", "klines"))
def s04(spark, sf):
    first = raw_klines(spark, sf).filter("ingest_seq = 1")
    return market.flow_from_klines(first).select("symbol", "date", S.presented("ofi", 9).alias("ofi"))


@query("s05_book_snapshot", sql(f"""
select symbol, cast(ts as date) as month, count(*) filter (side = 'O') as n_bids, count(*) filter (side = 'F') as n_asks,
       {r("sum(size) filter (side = 'O')")} as bid_size, {r("sum(size) filter (side = 'F')")} as ask_size
from levels where level <= 20 group by 1, 2""", "levels"))
def s05(spark, sf):
    # a third field per level, as some venues send it
    wide = lambda c: F.transform(c, lambda lv: F.concat(lv, F.array(F.lit(3.0)))).alias(c)
    raw = inputs.book(spark, sf).select("symbol", "ts", wide("bids"), wide("asks"))
    book = market.parse_book(raw)
    total = lambda c: F.when(F.size(c) > 0, F.aggregate(c, F.lit(0.0), lambda a, lv: a + lv[1]))
    return book.select(
        "symbol", F.to_date("ts").alias("month"), F.size("bids").cast("bigint").alias("n_bids"),
        F.size("asks").cast("bigint").alias("n_asks"), S.presented(total("bids"), 6).alias("bid_size"),
        S.presented(total("asks"), 6).alias("ask_size"))


def signal_log(spark, sf):
    """The day's candidates as a signal log, with indicator columns."""
    bars = inputs.bars(spark, sf)
    measured = indicators.blocked(bars, indicators.RSI_HALO, 0, lambda b: indicators.add_atr(indicators.add_rsi(b)))
    measured = measured.select("date", "symbol", "rsi", "atr_pct")
    logged = admitted(bars).withColumn("rf_prob", F.col("prob")).withColumn("xgb_prob", F.col("prob"))
    return sinks.signal_rows(logged.join(measured, ["date", "symbol"]))


SIGNAL_SQL = f"""
select l.date, l.symbol, cast(printf('%.6f', c.close) as double) as close, cast(printf('%.4f', l.prob) as double) as ensemble_prob, l.reject_reason = 'NONE' as signal_fired,
  l.reject_reason, cast(printf('%.4f', l.ofi) as double) + cast(0 as double) as ofi_value, case when l.ofi > 0 then 'YES' else 'NO' end as ofi_gate_pass, c.in_position
from logged l join cands c using (date, symbol)"""
SIGNAL_COLUMNS = ["date", "symbol", "close", "ensemble_prob", "signal_fired", "reject_reason", "ofi_value", "ofi_gate_pass", "in_position"]
part("signal_log", ["logged", "cands", "rsi", "atr"], SIGNAL_SQL + " join rsi using (date, symbol) join atr using (date, symbol)")


@query("s06_signal_log_reader", sql("""
select s.*, r.rsi is not null and a.atr_pct is not null as complete from signal_log s
join rsi r using (date, symbol) join atr a using (date, symbol)""", "signal_log", "rsi", "atr"))
def s06(spark, sf):
    # written as the CSV log, where a missing indicator is an empty cell, then read back
    path = scratch_path(spark, "signals-csv")
    signal_log(spark, sf).write.csv(path, header=True)
    good, legacy = logs.read_signals(spark, path)
    cols = SIGNAL_COLUMNS
    old = logs.typed(legacy.drop("n_cells"), schemas.SIGNALS)
    return good.select(*cols, F.lit(True).alias("complete")).unionByName(old.select(*cols, F.lit(False).alias("complete")))


def trade_log(spark, sf):
    """The ledger as text cells, with an unreadable date on the first of a month and an unreadable price on
    the second."""
    trades = inputs.trades(inputs.bars(spark, sf))
    day = F.dayofmonth("entry_date")
    text = lambda c: F.col(c).cast("string").alias(c)
    return trades.select(
        F.when(day == 1, "n/a").otherwise(F.col("entry_date").cast("string")).alias("date"), "symbol",
        F.when(F.weekday("entry_date") < 5, "Closed").otherwise("OPEN").alias("action"), text("entry_price"),
        F.when(day == 2, "?").otherwise(F.col("exit_price").cast("string")).alias("exit_price"), text("pnl_net"), "reason",
        F.lit("").alias("balance_after"), text("hold_days"),
    )


TRADE_LOG_SQL = f"""
select entry_date as date, symbol, case when isodow(entry_date) <= 5 then 'Closed' else 'OPEN' end as action,
  {r('entry_price')} as entry_price, case when day(entry_date) <> 2 then {r('exit_price')} end as exit_price, {r('pnl_net')} as pnl_net, reason
from trades where day(entry_date) <> 1"""


@query("s07_trade_log_reader", sql(TRADE_LOG_SQL, "trades"))
def s07(spark, sf):
    path = scratch_path(spark, "trades-csv")
    trade_log(spark, sf).write.csv(path, header=True)
    back = logs.read_trades(spark, path)
    return rounded(back.select("date", "symbol", "action", "entry_price", "exit_price", "pnl_net", "reason"))


@query("s08_stored_results", sql(f"""
select symbol, entry_date, reason, {r('pnl_net')} as pnl_net, 'venue_ofi' as run_config
from trades where ofi > 0 and entry_date between date '1996-01-01' and date '1997-06-30'""", "trades"))
def s08(spark, sf):
    path = scratch_path(spark, "results")
    trades = materialize(inputs.trades(inputs.bars(spark, sf)))
    sinks.write_results(trades, path, "venue", False)
    sinks.write_results(trades.filter("ofi > 0"), path, "venue", True)
    start, end = F.lit("1996-01-01").cast("date"), F.lit("1997-06-30").cast("date")
    stored = logs.read_results(spark, path, "venue_ofi", start, end)
    return rounded(stored.select("symbol", "entry_date", "reason", "pnl_net", "run_config"))


@query("s09_account_state", sql(f"""
select cast(date as varchar) as day, {r('balance', 4)} as balance, {r('peak', 4)} as peak_balance, tripped as halted
from trips where date = (select max(date) from trips)""", "trips"))
def s09(spark, sf):
    from ..operators import risk

    bars = inputs.bars(spark, sf)
    equity = materialize(ledger.equity_curve(inputs.trades(bars, 10.0), bars))
    rows = risk.with_drawdown(equity).select(
        F.col("date").cast("timestamp").alias("run_ts"), "balance", F.col("peak").alias("peak_balance"), F.col("tripped").alias("halted"))
    path = scratch_path(spark, "account")
    # one row per run: stored as JSON text, parsed, appended, read back as the latest state
    state.append(state.from_json(state.to_json(rows)), path)
    last = state.read(spark, path)
    return rounded(last.select(F.to_date("run_ts").cast("string").alias("day"), "balance", "peak_balance", "halted"))


@query("s10_append_signals", sql("""
select date, symbol, reject_reason, count(*) over (partition by date, symbol) as copies from logged""", "logged"))
def s10(spark, sf):
    rows = signal_log(spark, sf)
    path = scratch_path(spark, "signals")
    sinks.append_signals(rows, path)
    back = sinks.read_signals(spark, path, F.lit("1900-01-01").cast("date"), F.lit("2100-01-01").cast("date"))
    counted = back.groupBy("date", "symbol").agg(F.min("reject_reason").alias("reject_reason"), F.count(F.lit(1)).alias("copies"))
    return counted.select("date", "symbol", "reject_reason", "copies")


@query("s11_result_sink", sql("""
select 'venue' as run_config, reason, count(*) as n from trades group by 2
union all select 'venue_ofi', reason, count(*) from trades where ofi > 0 group by 2""", "trades"))
def s11(spark, sf):
    path = scratch_path(spark, "results")
    trades = materialize(inputs.trades(inputs.bars(spark, sf)))
    for gate in (False, True, False):  # a rerun replaces its own configuration only
        sinks.write_results(trades.filter("ofi > 0") if gate else trades, path, "venue", gate)
    return spark.read.parquet(path).groupBy("run_config", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("s12_create_missing", sql("""
select 'trades' as name, 19 as n_columns, count(*) as n_rows from trades
union all select 'signals', 13, count(*) from logged""", "trades", "logged"))
def s12(spark, sf):
    root = scratch_path(spark, "store")
    sinks.create_missing(spark, root)
    bars = inputs.bars(spark, sf)
    sinks.append_signals(signal_log(spark, sf), f"{root}/signals_by_month")
    closed = inputs.trades(bars)
    have = {c: F.col(c) for c in closed.columns}
    have["date"] = F.col("entry_date")
    types = {f.name: f.dataType for f in schemas.struct(schemas.TRADES)}
    sinks.append_trades(closed.select(*[have.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()]), f"{root}/trades")
    if sinks.create_missing(spark, root):  # nothing is missing any more, and nothing is overwritten
        raise RuntimeError("a table was created twice")

    def count(name, t):
        return t.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("name"), F.lit(len(t.columns)).alias("n_columns"), "n_rows")

    every = F.lit("1900-01-01").cast("date"), F.lit("2100-01-01").cast("date")
    signals = sinks.read_signals(spark, f"{root}/signals_by_month", *every)
    return count("trades", spark.read.parquet(f"{root}/trades")).unionByName(count("signals", signals))


# ---- filters ----

@query("f01_valid_bars", sql("select symbol, count(*) as n from klines where low is not null and close > 0 group by 1", "klines"))
def f01(spark, sf):
    valid = market.valid_bars(market.parse_klines(raw_klines(spark, sf)))
    return valid.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


@query("f02_feature_rows", sql("select symbol, count(*) as n, min(date) as first_date, count(atr_pct_z) as n_z from features group by 1", "features"))
def f02(spark, sf):
    return full_features(spark, sf).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.count("atr_pct_z").alias("n_z"))


part("supplier_days", [], """
select 'S' || l_suppkey as symbol, cast(l_shipdate as date) as date, sum(l_extendedprice)/sum(l_quantity) as close
from lineitem group by 1, 2
""")


@query("f03_minimum_history", sql("""
select symbol, count(*) as n_bars, min(date) as first_date from supplier_days group by 1 having count(*) >= 560""", "supplier_days"))
def f03(spark, sf):
    # many symbols of different length: one per supplier
    lines = inputs.table(spark, sf, "lineitem")
    days = lines.groupBy("l_suppkey", F.to_date("l_shipdate").alias("date")).agg(
        (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("close"))
    days = days.select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"), "date", "close")
    kept = market.enough_history(days, 560)
    return kept.groupBy("symbol").agg(F.max("n_bars").alias("n_bars"), F.min("date").alias("first_date"))


@query("f04_partial_bar", sql("""
select symbol, max(date) as last_date, case when max(date) >= (select max(date) from bars) then 'partial' else 'complete' end as state
from bars group by 1""", "bars"))
def f04(spark, sf):
    bars = inputs.bars(spark, sf)
    run = bars.agg(F.max("date").alias("run_date"))
    # the run date is one row
    last = bars.groupBy("symbol").agg(F.max("date").alias("last_date")).crossJoin(F.broadcast(run))
    return last.select("symbol", "last_date", market.bar_state(F.col("last_date"), F.col("run_date")).alias("state"))


@query("f05_latest_complete_bar", sql(f"""
select symbol, date, {r('close')} as close from bars where date = date '1997-03-04' - 1""", "bars"))
def f05(spark, sf):
    return show(market.latest_complete(inputs.bars(spark, sf), F.lit("1997-03-04").cast("date")), "close")


part("book_rows", ["pos", "exits"], """
select p.entry_date as date, p.symbol, case when e.reason is null or e.exit_date >= date '1998-06-01' then 'OPEN' else 'CLOSED' end as action,
       case when e.reason is null or e.exit_date >= date '1998-06-01' then null else e.exit_price end as exit_price
from pos p left join exits e on e.symbol = p.symbol and e.entry_date = p.entry_date
""")


def book_rows(spark, sf):
    """The ledger as of one day: exits after it have not happened yet."""
    both = inputs.exited(inputs.bars(spark, sf))
    still = F.col("reason").isNull() | (F.col("exit_date") >= F.lit("1998-06-01").cast("date"))
    return both.select(
        F.col("entry_date").alias("date"), "symbol", F.when(still, "OPEN").otherwise("CLOSED").alias("action"),
        F.when(~still, F.col("exit_price")).alias("exit_price"))


AS_OF = "1998-06-01"


@query("f06_open_positions", sql("""
select date, symbol, date >= date '1998-06-01' - 90 as managed from book_rows where action = 'OPEN' and exit_price is null""", "book_rows"))
def f06(spark, sf):
    rows, run = materialize(book_rows(spark, sf)), F.lit(AS_OF).cast("date")
    managed = ledger.open_positions(rows, run).select("date", "symbol", F.lit(True).alias("managed"))
    return managed.unionByName(ledger.stale_positions(rows, run).select("date", "symbol", F.lit(False).alias("managed")))


@query("f07_wanted_signals", sql("""
select date, symbol, case when reject_reason = 'NONE' then 'OFI_PASS' else 'OFI_BLOCKED' end as "group"
from logged where reject_reason = 'NONE' or starts_with(reject_reason, 'OFI_NEGATIVE')""", "logged"))
def f07(spark, sf):
    return compare.wanted_signals(admitted(inputs.bars(spark, sf))).select("date", "symbol", "group")


@query("f08_closed_and_open", sql("""
select symbol, case when isodow(entry_date) <= 5 then 'closed' else 'open' end as side, count(*) as n
from trades where day(entry_date) <> 1 group by 1, 2""", "trades"))
def f08(spark, sf):
    closed, still = logs.closed_and_open(logs.typed_trades(materialize(trade_log(spark, sf))))
    both = closed.withColumn("side", F.lit("closed")).unionByName(still.withColumn("side", F.lit("open")))
    return both.groupBy("symbol", "side").agg(F.count(F.lit(1)).alias("n"))


@query("f09_date_window", sql("""
select symbol, entry_date, exit_date, reason from exits where entry_date between date '1996-01-01' and date '1996-12-31'""", "exits"))
def f09(spark, sf):
    closed = exits.resolved(inputs.exited(inputs.bars(spark, sf)))
    year = compare.in_window(closed, "entry_date", F.lit("1996-01-01").cast("date"), F.lit("1996-12-31").cast("date"))
    return year.select("symbol", "entry_date", "exit_date", "reason")


@query("f10_fill_missing", sql("""
select symbol, date, """ + ", ".join(f"{r(f'coalesce({c}, 0)')} as {c}" for c in ("ret_20d", "atr_pct_z", "vol_z", "fg_momentum"))
    + " from features where target is not null", "features"))
def f10(spark, sf):
    return show(training.labeled(full_features(spark, sf)), "ret_20d", "atr_pct_z", "vol_z", "fg_momentum")


@query("f11_universe", sql("""
select symbol, count(*) as n from bars where symbol in (select distinct l_returnflag from lineitem where l_linestatus = 'F') group by 1""", "bars"))
def f11(spark, sf):
    universe = inputs.table(spark, sf, "lineitem").filter("l_linestatus = 'F'").select(F.col("l_returnflag").alias("symbol")).distinct()
    return inputs.bars(spark, sf).join(universe, "symbol", "left_semi").groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


@query("f12_signal_and_gate", sql("""
select date, symbol, prob >= 0.6 as signal, ofi > 0 as gate from cands""", "cands"))
def f12(spark, sf):
    return inputs.candidates(inputs.bars(spark, sf)).select(
        "date", "symbol", (F.col("prob") >= RULES.signal_threshold).alias("signal"), (F.col("ofi") > RULES.flow_gate).alias("gate"))


# ---- scalar functions, on whole tables ----

def table(spark, sf, name):
    return inputs.table(spark, sf, name)


@query("c01_sign", sql("select o_orderkey, sign(o_totalprice - 150000) + cast(0 as double) as s from orders"))
def c01(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", (F.signum(F.col("o_totalprice") - 150000) + F.lit(0.0)).alias("s"))


@query("c02_gain_loss", sql(f"""
select symbol, date, {r('case when delta is not null then greatest(delta, 0) end')} as gain,
       {r('case when delta is not null then greatest(-delta, 0) end')} as loss from delta""", "delta"))
def c02(spark, sf):
    from ..functions import rolling as R

    moved = indicators.blocked(inputs.bars(spark, sf), 1, 0, lambda b: b.withColumn("delta", R.difference("close", indicators.W())))
    return show(moved.select("*", S.gain(F.col("delta")).alias("gain"), S.loss(F.col("delta")).alias("loss")), "gain", "loss")


@query("c03_abs_and_row_max", sql(f"select symbol, date, {r('abs(close - open)')} as body, {r('tr')} as tr from ranges", "ranges"))
def c03(spark, sf):
    df = indicators.blocked(inputs.bars(spark, sf), 1, 0, lambda b: b.select(
        "*", F.abs(F.col("close") - F.col("open")).alias("body"),
        S.true_range(F.col("high"), F.col("low"), F.lag("close").over(indicators.W())).alias("tr")))
    return show(df, "body", "tr")


@query("c04_guarded_division", sql(f"select s_suppkey, {r('s_acctbal/nullif(s_nationkey, 0)')} as q from supplier"))
def c04(spark, sf):
    return table(spark, sf, "supplier").select(
        "s_suppkey", S.presented(S.guarded_ratio(F.col("s_acctbal"), F.col("s_nationkey").cast("double")), 6).alias("q"))


@query("c05_epsilon_division", sql(f"""
select l_returnflag, l_linestatus, {r('sum(l_discount/(l_tax + 1e-10)) filter (l_tax > 0)', 4)} as s, count(*) filter (l_discount/(l_tax + 1e-10) > 1e6) as n_large
from lineitem group by 1, 2"""))
def c05(spark, sf):
    q = S.epsilon_ratio(F.col("l_discount"), F.col("l_tax"))
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        S.presented(F.sum(F.when(F.col("l_tax") > 0, q)), 4).alias("s"), F.count_if(q > 1e6).alias("n_large"))


@query("c06_comparison_flag", sql("""
select symbol, date, cast(coalesce(rsi < 30, false) as integer) as low, cast(coalesce(atr_pct > 0.02, false) as integer) as wide
from rsi join atr using (symbol, date)""", "rsi", "atr"))
def c06(spark, sf):
    df = indicators.blocked(inputs.bars(spark, sf), indicators.RSI_HALO, 0, lambda b: indicators.add_atr(indicators.add_rsi(b)))
    return df.select("symbol", "date", S.flag(F.col("rsi") < 30).alias("low"), S.flag(F.col("atr_pct") > F.lit(0.02)).alias("wide"))


@query("c07_day_of_week", sql("select cast(isodow(o_orderdate) - 1 as integer) as dow, count(*) as n from orders group by 1"))
def c07(spark, sf):
    return table(spark, sf, "orders").groupBy(S.day_of_week("o_orderdate").alias("dow")).agg(F.count(F.lit(1)).alias("n"))


@query("c08_epoch_to_date", sql("""
select event_id, cast(ts as date) as from_ms, cast(ts as date) as from_s from events"""))
def c08(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return events.select("event_id", S.millis_to_date(F.unix_millis("ts")).alias("from_ms"), S.seconds_to_date(F.unix_seconds("ts")).alias("from_s"))


@query("c09_calendar_days", sql("""
select l_orderkey, l_linenumber, cast(date_diff('day', o_orderdate, l_shipdate) as integer) as days, cast(l_shipdate as date) - 90 as cutoff
from lineitem join orders on o_orderkey = l_orderkey"""))
def c09(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", F.datediff("l_shipdate", "o_orderdate").alias("days"),
                         F.date_sub(F.to_date("l_shipdate"), 90).alias("cutoff"))


@query("c10_parse_date", sql("""
select o_orderkey, case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as parsed from orders"""))
def c10(spark, sf):
    text = F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf, "orders").select("o_orderkey", S.parse_date(text).alias("parsed"))


@query("c11_parse_number", sql("""
select p_partkey, case when p_size > 5 then p_retailprice end as price, try_cast(regexp_extract(p_brand, '[0-9]+') as double) as brand from part"""))
def c11(spark, sf):
    text = F.when(F.col("p_size") > 5, F.col("p_retailprice").cast("string")).otherwise(F.when(F.col("p_size") > 2, "").otherwise("n/a"))
    return table(spark, sf, "part").select(
        "p_partkey", S.parse_number(text).alias("price"), S.parse_number(F.regexp_extract("p_brand", "[0-9]+", 0)).alias("brand"))


@query("c12_parse_flag", sql("select c_custkey, c_acctbal > 0 as positive from customer"))
def c12(spark, sf):
    text = F.when(F.col("c_acctbal") > 0, F.when(F.col("c_nationkey") > 10, " TRUE ").otherwise("True")).otherwise(
        F.when(F.col("c_nationkey") > 10, "no"))
    return table(spark, sf, "customer").select("c_custkey", S.parse_flag(text).alias("positive"))


@query("c13_reason_families", sql("""
select starts_with(reason, 'TRAIL') as trail, starts_with(reason, 'MAX_HOLD') as max_hold, count(*) as n from exits group by 1, 2""", "exits"))
def c13(spark, sf):
    closed = exits.resolved(inputs.exited(inputs.bars(spark, sf)))
    text = exits.reason_text(F.col("reason"), F.col("hold_days"))
    return closed.groupBy(text.startswith("TRAIL").alias("trail"), text.startswith("MAX_HOLD").alias("max_hold")).agg(F.count(F.lit(1)).alias("n"))


@query("c14_format_reason", sql("""
select date, symbol, 'PROB_TOO_LOW_' || printf('%.4f', prob) as low,
       'OFI_NEGATIVE_' || printf('%+.4f', ofi) as negative from cands""", "cands"))
def c14(spark, sf):
    return inputs.candidates(inputs.bars(spark, sf)).select(
        "date", "symbol", S.prob_too_low(F.col("prob")).alias("low"), S.flow_negative(F.col("ofi")).alias("negative"))


@query("c15_split_reason", sql("""
select date, symbol, case when reject_reason like 'PROB%' then 'PROB_TOO_LOW' when reject_reason like 'OFI%' then 'OFI_NEGATIVE' else reject_reason end as code,
  case when reject_reason like 'PROB%' then cast(printf('%.4f', prob) as double) when reject_reason like 'OFI%' then cast(printf('%.4f', ofi) as double) + cast(0 as double) end as value
from logged""", "logged"))
def c15(spark, sf):
    rows = admitted(inputs.bars(spark, sf))
    return rows.select("date", "symbol", S.reason_code(F.col("reject_reason")).alias("code"), S.reason_value(F.col("reject_reason")).alias("value"))


@query("c16_row_id", sql("select o_orderkey, case when o_orderkey < 10000 then 'T' || lpad(cast(o_orderkey as varchar), 4, '0') else 'T' || o_orderkey end as row_id from orders"))
def c16(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", S.row_id(F.col("o_orderkey")).alias("row_id"))


@query("c17_rounding", sql("""
select symbol, date, cast(printf('%.2f', close) as double) as d2, cast(printf('%.4f', close) as double) as d4, cast(printf('%.6f', close) as double) as d6 from bars""", "bars"))
def c17(spark, sf):
    return inputs.bars(spark, sf).select("symbol", "date", *[S.half_even("close", k).alias(f"d{k}") for k in (2, 4, 6)])


@query("c18_sentiment_label", sql("""
select case when value <= 25 then 'Extreme Fear' when value <= 49 then 'Fear' when value <= 74 then 'Greed' else 'Extreme Greed' end as label,
       count(*) as n from sentiment group by 1""", "sentiment"))
def c18(spark, sf):
    return inputs.sentiment(spark, sf).groupBy(S.sentiment_label(F.col("value")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("c19_benchmark_label", sql("""
select symbol, date, case when week*100 > 5 then 'leading' when week is not null then 'neutral' end as label
from (select symbol, date, close/lag(close, 7) over (partition by symbol order by date) - 1 as week from bars)""", "bars"))
def c19(spark, sf):
    from ..functions import rolling as R

    week = indicators.blocked(inputs.bars(spark, sf), 7, 0, lambda b: b.withColumn("week", R.change("close", indicators.W(), 7)))
    return week.select("symbol", "date", S.benchmark_label(F.col("week")).alias("label"))


@query("c20_percent", sql(f"select symbol, date, {r('atr_pct*100', 4)} as atr_percent, {r('atr_pct*100/100')} as fraction from atr", "atr"))
def c20(spark, sf):
    df = indicators.blocked(inputs.bars(spark, sf), indicators.ATR_HALO, 0, indicators.add_atr)
    return df.select("symbol", "date", S.presented(F.col("atr_pct") * 100, 4).alias("atr_percent"), S.presented(F.col("atr_pct") * 100 / 100, 6).alias("fraction"))


@query("c21_level_sizes", sql(f"""
select symbol, cast(ts as date) as month, {r("coalesce(sum(size) filter (side = 'O' and level <= 5), 0)")} as bid5,
       {r("coalesce(sum(size) filter (side = 'F' and level <= 5), 0)")} as ask5 from levels where level <= 20 group by 1, 2""", "levels"))
def c21(spark, sf):
    return inputs.book(spark, sf).select(
        "symbol", F.to_date("ts").alias("month"), S.presented(S.level_sizes(F.col("bids"), 5), 6).alias("bid5"),
        S.presented(S.level_sizes(F.col("asks"), 5), 6).alias("ask5"))


@query("c22_state_json", sql("""
select c_custkey, cast(printf('%.4f', c_acctbal) as double) as balance, c_acctbal < 0 as halted, cast(10000 as double) as peak_balance from customer"""))
def c22(spark, sf):
    # text written and parsed again; the peak is missing, so it takes its default
    doc = F.to_json(F.struct(F.col("c_acctbal").alias("balance"), F.when(F.col("c_acctbal") < 0, "True").otherwise("False").alias("halted")))
    keyed = table(spark, sf, "customer").select("c_custkey", doc.alias("payload"))
    p = F.from_json("payload", state.STATE_JSON)
    return keyed.select("c_custkey", p.alias("p")).select(
        "c_custkey", S.half_even(S.parse_number(F.col("p.balance")), 4).alias("balance"), S.parse_flag(F.col("p.halted")).alias("halted"),
        F.coalesce(S.parse_number(F.col("p.peak_balance")), F.lit(RULES.start_balance)).alias("peak_balance"))


@query("c23_filled_cells", sql("""
select symbol, date, cast((rsi is not null)::int + (ag is not null)::int + (delta is not null)::int + 1 as integer) as n from rsi""", "rsi"))
def c23(spark, sf):
    from ..functions import rolling as R

    def build(b):
        b = b.withColumn("delta", R.difference("close", indicators.W()))
        b = b.withColumn("ag", R.full(F.avg, S.gain(F.col("delta")), indicators.W(), 14))
        return indicators.add_rsi(b)

    df = indicators.blocked(inputs.bars(spark, sf), indicators.RSI_HALO, 0, build)
    return df.select("symbol", "date", S.filled_cells(["rsi", "ag", "delta", "close"]).alias("n"))


# ---- sorts, limits, sets ----

@query("k01_sorted_trades", sql("""
select row_number() over (order by exit_date, symbol, entry_date) as position, exit_date, symbol, entry_date from exits""", "exits"))
def k01(spark, sf):
    closed = exits.resolved(inputs.exited(inputs.bars(spark, sf))).select("exit_date", "symbol", "entry_date")
    return series.global_running(closed, ["exit_date", "symbol", "entry_date"], position=("count",))


@query("k02_ranked_candidates", sql("""
select date, symbol, prob, row_number() over (partition by date order by prob desc, symbol) as rank from cands qualify rank <= 3""", "cands"))
def k02(spark, sf):
    return admission.ranked(inputs.candidates(inputs.bars(spark, sf)), RULES.max_positions).select("date", "symbol", "prob", "rank")


@query("k02_ranked_of_many", sql("""
select date, symbol, prob, row_number() over (partition by date order by prob desc, symbol) as rank from (
  select cast(l_shipdate as date) as date, cast(l_suppkey as varchar) as symbol, (sum(l_quantity::bigint) % 100)/100.0::double as prob from lineitem group by 1, 2)
qualify rank <= 3"""))
def k02_many(spark, sf):
    """Candidates of as many symbols as there are suppliers: most of them fall to the cut."""
    lines = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date"), F.col("l_suppkey").cast("string").alias("symbol"), "l_quantity")
    sums = lines.groupBy("date", "symbol").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("n"))
    cands = sums.select("date", "symbol", ((F.col("n") % 100) / F.lit(100.0)).alias("prob"))
    return admission.ranked(cands, RULES.max_positions).select("date", "symbol", "prob", "rank")


@query("k03_last_training_rows", sql("select symbol, date, back from trainable where back <= 180", "trainable"))
def k03(spark, sf):
    return training.training_window(full_features(spark, sf)).select("symbol", "date", "back")


@query("k04_holdout_split", sql("""
select symbol, back <= 20 as holdout, count(*) as n, min(date) as first_date, max(date) as last_date from trainable where back <= 180 group by 1, 2""", "trainable"))
def k04(spark, sf):
    return training.split(training.training_window(full_features(spark, sf))).groupBy("symbol", "holdout").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query("k05_top5", sql(f"""
select p_type as feature, {r('sum(l_extendedprice)', 2)} as importance from lineitem join part on p_partkey = l_partkey
group by 1 order by sum(l_extendedprice) desc, 1 limit 5"""))
def k05(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("feature"))
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_extendedprice")
    # summed per part before the join, so the join moves one row per part and task
    per_part = lines.groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("s"))
    sums = per_part.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("feature").agg(F.sum("s").alias("importance"))
    return rounded(training.top_importances(sums), 2)


@query("k06_top20_levels", sql(f"""
select symbol, cast(ts as date) as month, side, count(*) as n, {r('sum(size)')} as size from levels where level <= 20 group by 1, 2, 3""", "levels"))
def k06(spark, sf):
    sides = F.explode(F.array(
        F.struct(F.lit("O").alias("side"), F.col("bids").alias("lv")), F.struct(F.lit("F").alias("side"), F.col("asks").alias("lv"))))
    rows = inputs.book(spark, sf).select("symbol", F.to_date("ts").alias("month"), sides.alias("s")).select("symbol", "month", "s.*")
    total = F.aggregate("lv", F.lit(0.0), lambda a, x: a + x[1])
    return rows.filter(F.size("lv") > 0).select("symbol", "month", "side", F.size("lv").cast("bigint").alias("n"), S.presented(total, 6).alias("size"))


@query("k07_first_later_bars", sql("select symbol, entry_date, count(*) as n, max(date) as last_date from path group by 1, 2", "path"))
def k07(spark, sf):
    bars = inputs.bars(spark, sf)
    placed = exits.at_entry(inputs.rsi_positions(bars), exits.with_path(bars, RULES.max_hold + 2))
    rows = exits.position_bars(placed)
    return rows.groupBy("symbol", "entry_date").agg(F.count(F.lit(1)).alias("n"), F.max("date").alias("last_date"))


@query("k08_calendar_union", sql("""
select date, count(b.symbol) as n_symbols from (select distinct date from bars union select cast(o_orderdate as date) from orders) c
left join bars b using (date) group by 1""", "bars"))
def k08(spark, sf):
    bars = inputs.bars(spark, sf)
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"))
    days = bars.select("date").union(orders).distinct()
    return days.join(bars.groupBy("date").agg(F.count(F.lit(1)).alias("n")), "date", "left").select("date", F.coalesce("n", F.lit(0)).alias("n_symbols"))


@query("k09_symbol_sets", sql("""
select symbol, entry_date, 'closed' as state from exits union
select p.symbol, p.entry_date, 'open' from pos p where not exists (select 1 from exits e where e.symbol = p.symbol and e.entry_date = p.entry_date)""", "pos", "exits"))
def k09(spark, sf):
    both = materialize(inputs.exited(inputs.bars(spark, sf)))
    keys = both.select("symbol", "entry_date")
    closed = exits.resolved(both).select("symbol", "entry_date")
    left = keys.exceptAll(closed)
    return closed.withColumn("state", F.lit("closed")).union(left.withColumn("state", F.lit("open"))).distinct()
