"""Studies (X1-X14) and model queries."""

from __future__ import annotations

import itertools
import math
from dataclasses import replace

from pyspark.sql import functions as F

from ..functions import rolling as R
from ..functions import scalars as S
from ..operators import admission, ensembles, exits, indicators, ledger, metrics, research, series, training, windowed
from ..params import FEATURES, RULES
from ..session import materialize
from . import inputs
from .q_indicators import full_features
from .q_positions import admitted
from .q_results import PF_SQL, rounded, trades_of
from .registry import query
from .sqlparts import d, exits_parts, part, r, sql, trades_part

# ---- studies ----


@query("x01_score_quartiles", sql(f"""
select tile, count(*) as n, min(signal_prob) as prob_min, max(signal_prob) as prob_max, {r('avg(cast(win as double))*100')} as win_pct,
  {r(PF_SQL)} as profit_factor
from (select *, cast(ntile(4) over (order by signal_prob, symbol, entry_date) as integer) as tile from trades) group by 1""", "trades"))
def x01(spark, sf):
    return rounded(research.by_score_quartile(trades_of(spark, sf)))


@query("x02_score_correlation", sql(f"select {r('corr(signal_prob, pnl_net)')} as correlation, count(*) as n from trades", "trades"))
def x02(spark, sf):
    return rounded(research.score_correlation(trades_of(spark, sf)))


# setting, take_profit, stop_loss, trigger, threshold
SETTINGS = [
    ("tp15", 0.015, 0.01, 0.015, 0.0), ("tp20", 0.02, 0.01, 0.015, 0.0), ("tp30", 0.03, 0.01, 0.015, 0.0),
    ("tp50", 0.05, 0.01, 0.015, 0.0), ("tp80", 0.08, 0.01, 0.015, 0.0), ("trig10", 0.03, 0.01, 0.01, 0.0),
    ("trig20", 0.03, 0.01, 0.02, 0.0), ("prob55", 0.03, 0.01, 0.015, 0.55), ("prob65", 0.03, 0.01, 0.015, 0.65),
]
part("settings", [], "select * from (values " + ", ".join(
    f"('{n}', {d(a)}, {d(b)}, {d(c)}, {d(t)})" for n, a, b, c, t in SETTINGS) + ") t(setting, take_profit, stop_loss, trig, threshold)")
part("swept_pos", ["pos", "settings"], "select p.*, s.* from pos p cross join settings s where p.signal_prob >= s.threshold")
exits_parts("v", "swept_pos", tp="take_profit", sl="stop_loss", trig="trig", extra=", setting")
trades_part("vtrades", "vexits")
part("vpath_keys", ["vexits"], "select * from vexits")


def _fix_sweep() -> None:
    """The swept positions carry their rates through to the exits."""
    from .sqlparts import PARTS

    needs, text = PARTS["vexits"]
    PARTS["vexits"] = (needs, text.replace("symbol, entry_date, setting, entry_price", "symbol, entry_date, setting, take_profit, stop_loss, trig, entry_price", 1))


_fix_sweep()


@query("x03_parameter_sweep", sql(f"""
select setting, count(*) as n, {r('avg(cast(win as double))*100')} as win_pct, {r(PF_SQL)} as profit_factor, {r('sum(pnl_net)')} as net
from vtrades group by 1""", "vtrades"))
def x03(spark, sf):
    settings = spark.createDataFrame(SETTINGS, "setting string, take_profit double, stop_loss double, trigger double, threshold double")
    swept = research.sweep(inputs.placed(inputs.bars(spark, sf)), settings)
    trades = ledger.with_pnl(swept.withColumn("trade_size", F.lit(RULES.trade_size)))
    return rounded(trades.groupBy("setting").agg(
        F.count(F.lit(1)).alias("n"), (F.avg(F.col("win").cast("double")) * 100).alias("win_pct"),
        metrics.profit_factor().alias("profit_factor"), F.sum("pnl_net").alias("net")))


part("mfe", ["path"], """
select symbol, entry_date, max(high)/entry_price - 1 as mfe from path where hold <= 5 group by symbol, entry_date, entry_price
""")


@query("x04_excursion", sql(f"""
select count(mfe) as n, {r('avg(mfe)')} as mean_mfe, {r('avg(cast(mfe >= 0.05 as double))')} as share_5pct,
  {r('avg(cast(mfe >= 0.08 as double))')} as share_8pct, {r('avg(cast(mfe >= 0.02 as double))')} as share_2pct from mfe""", "mfe"))
def x04(spark, sf):
    return rounded(research.excursion_summary(research.excursion(inputs.placed(inputs.bars(spark, sf)))))


part("mfe_long", ["pos", "bars"], """
select p.symbol, p.entry_date, (select max(b.high) from bars b where b.symbol = p.symbol and b.date > p.entry_date and b.date <= p.entry_date + 250)/p.entry_price - 1 as mfe
from pos p
""")


@query("x04_long_excursion", sql(f"select symbol, entry_date, {r('mfe')} as mfe from mfe_long", "mfe_long"))
def x04_long(spark, sf):
    """The best price within 250 days of every position."""
    bars = materialize(inputs.bars(spark, sf))
    return rounded(research.excursion_over(inputs.rsi_positions(bars), bars, 250).select("symbol", "entry_date", "mfe"))


@query("x05_fill_audit", sql(f"""
select count(*) as n, count(*) filter (exit_open < entry_price*(1+{d(0.015)})) as n_below,
  {r(f'avg(cast(exit_open < entry_price*(1+{d(0.015)}) as double))')} as share_below,
  {r(f'avg((entry_price*(1+{d(0.015)}) - exit_price)/entry_price)', 9)} as mean_gap_pct from exits where reason = 'TRAIL_BE'""", "exits"))
def x05(spark, sf):
    return rounded(research.fill_audit(inputs.exited(inputs.bars(spark, sf))), mean_gap_pct=9)


# distribution of a Poisson(1) number, up to what 52 bits can tell
POISSON = list(itertools.accumulate(math.exp(-1) / math.factorial(k) for k in range(18)))
part("gaps", ["trades"], f"""
select symbol, entry_date, (entry_price*(1 + {d(0.015)}) - exit_price)/entry_price*trade_size as delta from trades where reason = 'TRAIL_BE'""")
part("draws", ["gaps"], f"""
select replicate, sum(delta*w)/nullif(sum(w), 0) as m from (
  select replicate, delta, {" + ".join(f"cast(u > {d(t)} as integer)" for t in POISSON)} as w from (
    select replicate, delta, (('0x' || substr(md5('42|' || replicate || '|' || symbol || '|' || cast(entry_date as varchar)), 1, 13))::bigint + 0.5)/{d(float(1 << 52))} as u
    from gaps, (select unnest(range(1, 201)) as replicate))) group by 1""")


@query("x06_bootstrap", sql(f"""
select {r('quantile_cont(m, 0.025)')} as low, {r('quantile_cont(m, 0.975)')} as high, {r('avg(m)')} as boot_mean from draws""", "draws"))
def x06(spark, sf):
    # what the realism cap costs per armed-stop trade, in money
    closed = trades_of(spark, sf).filter("reason = 'TRAIL_BE'")
    trigger = exits.levels(F.col("entry_price"))["trigger"]
    delta = (trigger - F.col("exit_price")) / F.col("entry_price") * F.col("trade_size")
    values = closed.select("symbol", "entry_date", delta.alias("delta"))
    return rounded(research.bootstrap_mean(values, "delta", ["symbol", "entry_date"]))


Z = "1.959963984540054::double"


@query("x07_binomial_interval", sql(f"""
select symbol, n, wins,
  {r(f'(p + {Z}*{Z}/(2*n) - {Z}*sqrt(p*(1-p)/n + {Z}*{Z}/(4.0::double*n*n)))/(1 + {Z}*{Z}/n)')} as low,
  {r(f'(p + {Z}*{Z}/(2*n) + {Z}*sqrt(p*(1-p)/n + {Z}*{Z}/(4.0::double*n*n)))/(1 + {Z}*{Z}/n)')} as high
from (select symbol, count(*) as n, count(*) filter (win) as wins, avg(cast(win as double)) as p from trades group by 1)""", "trades"))
def x07(spark, sf):
    counted = trades_of(spark, sf).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.count_if("win").alias("wins"))
    return rounded(counted.select("symbol", "n", "wins", *research.wilson(F.col("wins"), F.col("n"))))


RISKS = [0.01, 0.05, 0.10, 0.15, 0.20, 0.25]
part("sized", ["exits"], f"""
select risk, date, {d(10000)}*exp(sum(ln(1 + risk/3*day_pct)) over (partition by risk order by date rows between unbounded preceding and current row)) as balance
from (select exit_date as date, sum(pnl_pct - 2*{d(0.0026)}) as day_pct from exits group by 1) cross join (values {', '.join(f'({d(x)})' for x in RISKS)}) t(risk)
""")


@query("x08_sizing", sql(f"""
select risk, {r('arg_max(balance, date)/10000 - 1')} as total_return, {r('min(balance/peak - 1)')} as max_drawdown
from (select *, greatest(max(balance) over (partition by risk order by date rows between unbounded preceding and current row), 10000) as peak from sized)
group by 1""", "sized"))
def x08(spark, sf):
    paths = materialize(research.recompounded(trades_of(spark, sf), RISKS))
    return rounded(research.sizing_summary(paths))


part("steps", ["exits"], """
select date, sum(sum(step)) over (order by date rows between unbounded preceding and current row) as n_open
from (select entry_date as date, 1 as step from exits union all select exit_date, -1 from exits) group by 1
""")


@query("x09_concurrency", sql(f"""
select cast(max(held) as bigint) as max_open, count(*) filter (held >= 3) as days_3_or_more, {r('avg(cast(held > 0 as double))')} as time_in_market
from (select c.date, coalesce(last_value(n_open ignore nulls) over (order by c.date rows between unbounded preceding and current row), 0) as held
      from calendar c left join steps s using (date))""", "calendar", "steps"))
def x09(spark, sf):
    bars = inputs.bars(spark, sf)
    levels = research.concurrency(materialize(inputs.trades(bars)))
    return rounded(research.concurrency_summary(materialize(levels), bars))


@query("x10_crash_scan", sql(f"""
select symbol, {r('min(r1)')} as worst_1d, arg_min(date, r1) as worst_1d_date, {r('min(r14)')} as worst_14d, arg_min(date, r14) as worst_14d_date
from (select symbol, date, close/lag(close) over w - 1 as r1, close/lag(close, 14) over w - 1 as r14 from bars
      window w as (partition by symbol order by date)) where r1 is not null group by 1""", "bars"))
def x10(spark, sf):
    moves = indicators.blocked(inputs.bars(spark, sf), 14, 0, lambda b: b.select(
        "symbol", "date", "block", "own", R.change("close", indicators.W()).alias("ret_1d"), R.change("close", indicators.W(), 14).alias("ret_14d")))
    return rounded(research.crash_scan(moves.filter(F.col("ret_1d").isNotNull())))


@query("x11_score_by_month", sql(f"""
select cast(date_trunc('month', date) as date) as month, count(*) as n, {r('stddev_samp(prob)')} as prob_std, min(prob) as prob_min, max(prob) as prob_max
from cands group by 1""", "cands"))
def x11(spark, sf):
    return rounded(research.score_by_month(inputs.candidates(inputs.bars(spark, sf))))


VARIANT_COLUMNS = ["win_rate", "profit_factor", "mean_pnl_pct", "sl_share", "tp_share", "trail_share"]
part("variants", ["trades"], f"""
select run_config, count(*) as n, avg(cast(pnl_net > 0 as double)) as win_rate, {PF_SQL} as profit_factor, avg(pnl_pct) as mean_pnl_pct,
  avg(cast(reason = 'SL' as double)) as sl_share, avg(cast(reason = 'TP' as double)) as tp_share, avg(cast(starts_with(reason, 'TRAIL') as double)) as trail_share
from (select *, 'gate_off' as run_config from trades union all select *, 'gate_on' from trades where ofi > 0) group by 1
""")


@query("x12_variants", sql(
    "select v.run_config, v.n, " + ", ".join(f"{r(f'v.{c} - b.{c}')} as d_{c}" for c in VARIANT_COLUMNS)
    + " from variants v, (select * from variants where run_config = 'gate_off') b", "variants"))
def x12(spark, sf):
    # tagged in one pass: every trade is in the ungated variant, those passing the gate in both
    tags = F.when(F.col("ofi") > RULES.flow_gate, F.array(F.lit("gate_off"), F.lit("gate_on"))).otherwise(F.array(F.lit("gate_off")))
    tagged = trades_of(spark, sf).withColumn("run_config", F.explode(tags))
    stats = materialize(research.variant_stats(tagged))
    return rounded(research.variant_deltas(stats, "gate_off"))


@query("x13_dormancy", sql(f"""
select symbol, max(date) filter (reject_reason = 'NONE') as last_fired,
  cast(date_diff('day', max(date) filter (reject_reason = 'NONE'), date '2002-01-01') as integer) as days_since, max(prob) as max_prob,
  {r('max(prob) - 0.6::double')} as over_threshold from logged group by 1""", "logged"))
def x13(spark, sf):
    logged = admitted(inputs.bars(spark, sf)).withColumn("ensemble_prob", F.col("prob"))
    return rounded(research.dormancy(logged, F.lit("2002-01-01").cast("date")))


part("runs", ["cands"], """
select date, symbol, run, prob*run/3 as ensemble_prob from cands, (values (1), (2), (3)) t(run) where run <= day(date) % 4
""")


@query("x14_duplicate_runs", sql("select date, symbol, count(*) as n from runs group by 1, 2 having count(*) > 1", "runs"))
def x14(spark, sf):
    return research.duplicate_runs(_runs(spark, sf), "run")[0]


@query("x14_latest_run", sql(f"select date, symbol, {r('arg_max(ensemble_prob, run)')} as ensemble_prob from runs group by 1, 2", "runs"))
def x14_latest(spark, sf):
    return rounded(research.duplicate_runs(_runs(spark, sf), "run")[1])


def _runs(spark, sf):
    """Up to three runs a day log the same signal."""
    cands = inputs.candidates(inputs.bars(spark, sf))
    n_runs = (F.dayofmonth("date") % 4)
    runs = cands.filter(n_runs > 0).withColumn("run", F.explode(F.sequence(F.lit(1), n_runs)))
    return runs.select("date", "symbol", "run", (F.col("prob") * F.col("run") / 3).alias("ensemble_prob"))


# ---- models ----

RETRAIN_DAYS = 5

part("fnum", ["features"], "select *, row_number() over (partition by symbol order by date) as fn from features")


@query("m01_training_rows", sql("""
select c.symbol, c.date as cutoff, count(*) as n, min(t.date) as first_date, max(t.date) as last_date, sum(t.target)::bigint as n_up
from fnum c join fnum t on t.symbol = c.symbol and t.fn between c.fn - 180 and c.fn - 1
where c.fn - 1 >= 80 and t.target is not null and c.date in (select max(date) from bars group by year(date)) group by 1, 2""", "fnum", "bars"))
def m01(spark, sf):
    bars = inputs.bars(spark, sf)
    cutoffs = bars.groupBy(F.year("date")).agg(F.max("date").alias("date")).select("date")
    rows = training.training_rows(materialize(full_features(spark, sf)), cutoffs)
    return rows.groupBy("symbol", "cutoff").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.sum("target").alias("n_up"))


part("wb", ["trainable"], "select symbol, " + ", ".join(
    f"quantile_cont(coalesce({c}, 0)::double, 0.01) as lo_{c}, quantile_cont(coalesce({c}, 0)::double, 0.99) as hi_{c}" for c in FEATURES)
    + " from trainable where back <= 180 group by 1")
part("clipped", ["trainable", "wb"], "select t.symbol, t.date, t.back, t.target, " + ", ".join(
    f"least(greatest(coalesce(t.{c}, 0)::double, lo_{c}), hi_{c}) as {c}" for c in FEATURES)
    + " from trainable t join wb using (symbol) where t.back <= 180")


@query("m02_winsorize", sql("select symbol, date, " + ", ".join(f"{r(c)} as {c}" for c in FEATURES) + " from clipped", "clipped"))
def m02(spark, sf):
    window = materialize(training.training_window(full_features(spark, sf)))
    return rounded(training.clip(window, training.winsor_bounds(window)).select("symbol", "date", *FEATURES))


@query("m03_scale", sql("select symbol, date, " + ", ".join(
    r(f"({c} - avg({c}) over (partition by symbol))/(case when stddev_pop({c}) over (partition by symbol) = 0 then 1 else stddev_pop({c}) over (partition by symbol) end)") + f" as {c}"
    for c in FEATURES) + " from clipped", "clipped"))
def m03(spark, sf):
    window = materialize(training.training_window(full_features(spark, sf)))
    clipped = materialize(training.clip(window, training.winsor_bounds(window)))
    return rounded(training.scale(clipped, training.scale_stats(clipped)).select("symbol", "date", *FEATURES))


# every input of every window before a day, for windows that slide by one row
part("sliding", ["fnum"], f"""
select symbol, date, feature, fn, count(*) filter (known) over w as n,
  quantile_cont(v, 0.01) filter (known) over w as lo, quantile_cont(v, 0.99) filter (known) over w as hi,
  avg(v) filter (known) over w as mean, min(v) filter (known) over w as least, max(v) filter (known) over w as most,
  stddev_pop(v) filter (known) over w as spread, list(v) filter (known) over w as held
from (unpivot (select symbol, date, fn, target is not null as known, {", ".join(f"coalesce({c}, 0)::double as {c}" for c in FEATURES)} from fnum)
      on {", ".join(FEATURES)} into name feature value v)
window w as (partition by symbol, feature order by fn rows between 180 preceding and 1 preceding)""")
part("cut", ["sliding"], """
select symbol, date, feature, list_transform(held, lambda v: least(greatest(v, lo), hi)) as held from sliding where fn - 1 >= 80""")


def _sliding(spark, sf):
    return materialize(windowed.training_stats(materialize(full_features(spark, sf))))


@query("a13_bounds_every_day", sql(f"select symbol, date, feature, {r('lo')} as lo, {r('hi')} as hi from sliding where fn - 1 >= 80", "sliding"))
def a13_every_day(spark, sf):
    return rounded(windowed.tall_stats(_sliding(spark, sf), ["lo", "hi"]))


@query("a14_scale_every_day", sql(f"""
select symbol, date, feature, {r('mean', 9)} as mean, {r('case when least = most then 1 else spread end', 7)} as std from sliding where fn - 1 >= 80""", "sliding"))
def a14_every_day(spark, sf):
    return rounded(windowed.tall_stats(_sliding(spark, sf), ["mean", "std"]), 9, std=7)


@query("m03_fit_every_day", sql(f"""
select symbol, date, feature, {r("list_aggregate(held, 'avg')", 9)} as fit_mean,
  {r("case when list_min(held) = list_max(held) then 1 else list_aggregate(held, 'stddev_pop') end", 7)} as fit_std from cut""", "cut"))
def m03_every_day(spark, sf):
    """What scales a row that is scored by a model refitted on its day."""
    return rounded(windowed.tall_stats(_sliding(spark, sf), ["fit_mean", "fit_std"]), 9, fit_std=7)


@query("a16_weights_every_day", sql(f"""
select symbol, date, n, n_up, {r('n/(2.0::double*nullif(n - n_up, 0))')} as weight_down, {r('n/(2.0::double*nullif(n_up, 0))')} as weight_up
from (select symbol, date, fn, count(target) over w as n, (sum(target) over w)::bigint as n_up from fnum
      window w as (partition by symbol order by fn rows between 180 preceding and 1 preceding)) where fn - 1 >= 80""", "fnum"))
def a16_every_day(spark, sf):
    return rounded(_sliding(spark, sf).select("symbol", "date", "n", "n_up", "weight_down", "weight_up"))


@query("w07_year_quartiles", sql(f"""
select symbol, date, {", ".join(r(f"case when count(atr_pct) over w = 250 then quantile_cont(atr_pct, {q}) over w end") + f" as q{int(q * 100)}" for q in (0.25, 0.75))}
from atr window w as (partition by symbol order by date rows between 249 preceding and current row)""", "atr"))
def w07_year(spark, sf):
    """Quartiles of the volatility over a year of bars, where sorting each frame would cost 250 values a row."""
    atr = materialize(indicators.blocked(inputs.bars(spark, sf), indicators.ATR_HALO, 0, indicators.add_atr))
    return rounded(windowed.quantiles(atr, "atr_pct", 250, {"q25": 0.25, "q75": 0.75}).select("symbol", "date", "q25", "q75"))


def _cutoff(features):
    """The last feature date: one value, which a fit needs on the driver."""
    return features.agg(F.max("date")).first()[0]


def _model_data(spark, sf):
    features = materialize(full_features(spark, sf))
    return features, _cutoff(features)


@query("m04_forest")
def m04(spark, sf):
    features, cutoff = _model_data(spark, sf)
    train, score = training.prepared(*training.at_cutoff(features, cutoff))
    model = training.forest(50).fit(materialize(train))
    return rounded(model.transform(score).select("symbol", "date", training._up("p_forest").alias("rf_prob")))


@query("m05_boosted")
def m05(spark, sf):
    features, cutoff = _model_data(spark, sf)
    train, score = training.prepared(*training.at_cutoff(features, cutoff))
    model = training.boosted(50).fit(materialize(train))
    return rounded(model.transform(score).select("symbol", "date", training._up("p_boosted").alias("xgb_prob")))


@query("m06_holdout")
def m06(spark, sf):
    return rounded(training.holdout_accuracy(*_model_data(spark, sf)))


@query("m07_ensemble")
def m07(spark, sf):
    return rounded(training.score_cutoff(*_model_data(spark, sf)))


@query("m08_importance")
def m08(spark, sf):
    features, cutoff = _model_data(spark, sf)
    train, _ = training.prepared(*training.at_cutoff(features, cutoff))
    model = training.forest(50).fit(materialize(train))
    return rounded(training.top_importances(training.importances(model)))


part("next_score", ["bbars"], """
select symbol, date, min(date) over (partition by symbol order by date range between interval 5 days following and unbounded following) as next_date
from bbars
""")
part("chain", ["next_score"], """
select symbol, min(date) as date from next_score group by 1
union all
select n.symbol, n.next_date from chain c join next_score n on n.symbol = c.symbol and n.date = c.date where n.next_date is not null
""")


@query("m09_cadence", sql("""
select b.symbol, b.date, max(c.date) as scored_on, arg_max((s.vi % 100)/100.0::double, c.date) as prob
from bbars b join chain c on c.symbol = b.symbol and c.date <= b.date and c.date > b.date - 15
join bbars s on s.symbol = c.symbol and s.date = c.date group by 1, 2""", "bbars", "chain"))
def m09(spark, sf):
    bars = materialize(inputs.business_bars(spark, sf))
    due = training.retrain_dates(bars, 5)
    scores = bars.join(due, ["symbol", "date"]).select("symbol", "date", inputs.score().alias("prob"))
    return training.reuse_scores(bars.select("symbol", "date"), scores)


@query("m10_insufficient_history", sql("""
select symbol, date, case when fn - 1 >= 80 then (vi % 100)/100.0::double else 0 end as prob,
       fn - 1 >= 80 and (vi % 100)/100.0::double >= 0.6 as signal
from fnum join (select symbol, date, vi from bars) b using (symbol, date)""", "fnum", "bars"))
def m10(spark, sf):
    features = series.ordinals(materialize(full_features(spark, sf)).drop("rn"), name="fn")
    enough = features.filter(F.col("fn") - 1 >= RULES.min_history)
    scores = enough.select("symbol", "date", ((F.col("volume").cast("bigint") % 100) / F.lit(100.0)).alias("prob"))
    return training.with_insufficient(features.select("symbol", "date"), scores)


def _quarter_ends(features):
    """(symbol, date) on the last feature day of every quarter."""
    ends = features.groupBy(F.trunc("date", "quarter")).agg(F.max("date").alias("date")).select("date")
    return features.select("symbol", "date").join(F.broadcast(ends), "date", "left_semi")  # four rows a year


part("result_days", ["fnum"], "select max(date) as date from fnum group by date_trunc('quarter', date)")


@query("m11_signal_result", sql("""
select f.symbol, f.date, count(t.date) as train_rows, count(t.date) < 80 as insufficient, true as in_range, true as mean_of_both, true as zero_if_insufficient,
  case when count(t.date) < 80 then 0 else 5 end as n_top
from fnum f join result_days using (date)
left join fnum t on t.symbol = f.symbol and t.target is not null and t.date < f.date and t.fn > f.fn - 181
group by 1, 2""", "fnum", "result_days"))
def m11(spark, sf):
    # keys, row counts and what must hold of every result; m07_one_split compares the numbers of trees that SQL can grow
    features = materialize(full_features(spark, sf))
    rows = ensembles.signals(features, _quarter_ends(features))
    share = lambda c: F.col(c).between(0, 1)
    known = ~F.col("insufficient")
    return rows.select(
        "symbol", "date", "train_rows", "insufficient", (share("rf_prob") & share("xgb_prob") & share("rf_accuracy") & share("xgb_accuracy")).alias("in_range"),
        (F.abs(F.col("ensemble_prob") - (F.col("rf_prob") + F.col("xgb_prob")) / 2) < 1e-12).alias("mean_of_both"),
        (known | ((F.col("ensemble_prob") == 0) & ~F.col("signal"))).alias("zero_if_insufficient"), F.size("top_features").alias("n_top"))


# one tree of one split per model, without draws: the same fits, which SQL can grow too
_KEY = "symbol, cutoff, w"
part("st_rows", ["fnum", "result_days"], f"""
select c.symbol, c.date as cutoff, c.fn, c.fn - t.fn as back, t.target,
  [{', '.join(f"round(coalesce(t.{c}, 0)::double, 6)" for c in FEATURES)}] as xs
from fnum c join result_days using (date) join fnum t on t.symbol = c.symbol and t.fn between c.fn - 180 and c.fn
where (t.target is not null or t.fn = c.fn) and c.fn > 80""")
part("st_fit", ["st_rows"], f"""
select symbol, cutoff, w, back, target, back > 20 * (1 - w) as fitted, unnest(range({len(FEATURES)})) as f, unnest(xs) as x
from st_rows, (values (0), (1)) v(w) where back > 0 or w = 1""")
part("st_bound", ["st_fit"], f"""
select {_KEY}, f, quantile_cont(x, 0.01) as lo, quantile_cont(x, 0.99) as hi, count(*) as n, sum(target) as n_up from st_fit where fitted group by all""")
part("st_bin", ["st_fit", "st_bound"], f"""
select *, (coalesce(sum(fitted::int) over (partition by {_KEY}, f order by clipped groups between unbounded preceding and 1 preceding), 0) * 32) // n as bin
from (select t.*, n, n_up, least(greatest(x, lo), hi) as clipped from st_fit t join st_bound using ({_KEY}, f))""")
part("st_left", ["st_bin"], f"""
select {_KEY}, f, bin, n, n_up, sum(count(*)) over upto as l, sum(sum(target)) over upto as l_up
from st_bin where fitted group by {_KEY}, f, bin, n, n_up window upto as (partition by {_KEY}, f order by bin rows between unbounded preceding and current row)""")
_D = "::double"
part("st_gain", ["st_left"], f"""
select *, pow(0.5*l - l_up, 2)/(0.25*l + 5) + pow(0.5*(n - l) - (n_up - l_up), 2)/(0.25*(n - l) + 5) - pow(0.5*n - n_up, 2)/(0.25*n + 5) as b_gain,
  2*(n{_D}/4 - a0*a1/nullif(a0 + a1, 0) - (n{_D}/2 - a0)*(n{_D}/2 - a1)/nullif(n - a0 - a1, 0)) as f_gain
from (select *, (l - l_up)*n{_D}/(2*(n - n_up)) as a0, l_up*n{_D}/(2*n_up) as a1 from st_left)""")
part("st_forest", ["st_gain"], f"""
select * from st_gain where l >= 5 and n - l >= 5 and round(f_gain, 9) > 0 qualify row_number() over (partition by {_KEY} order by round(f_gain, 9) desc, f, bin) = 1""")
part("st_boost", ["st_gain"], f"""
select * from st_gain where 0.25*l >= 5 and 0.25*(n - l) >= 5 and b_gain >= 0.5
qualify row_number() over (partition by {_KEY} order by round(b_gain, 9) desc, f, bin) = 1""")
part("st_up", ["st_bin", "st_forest", "st_boost"], f"""
select s.symbol, s.cutoff, s.w, s.back, s.target, any_value(t.f) as top,
  any_value(case when s.f = t.f then case when s.bin <= t.bin then t.a1/(t.a0 + t.a1) else (t.n{_D}/2 - t.a1)/(t.n - t.a0 - t.a1) end end) as rf,
  coalesce(any_value(case when s.f = b.f then 1/(1 + exp(0.05*case when s.bin <= b.bin then (0.5*b.l - b.l_up)/(0.25*b.l + 5)
    else (0.5*(b.n - b.l) - (b.n_up - b.l_up))/(0.25*(b.n - b.l) + 5) end)) end),
    any_value(1/(1 + exp(0.05*(0.5*s.n - s.n_up)/(0.25*s.n + 5))))) as xgb
from st_bin s left join st_forest t using ({_KEY}) left join st_boost b using ({_KEY})
where not s.fitted group by all""")


@query("m07_one_split", sql(f"""
select r.symbol, r.date, least(r.fn - 1, 180) as train_rows, r.fn <= 80 as insufficient, {r('coalesce(t.rf, 0)')} as rf_prob, {r('coalesce(t.xgb, 0)')} as xgb_prob,
  {r('coalesce((t.rf + t.xgb)/2, 0)')} as ensemble_prob, coalesce((t.rf + t.xgb)/2 >= 0.6, false) as signal, {r('coalesce(h.rf, 0)')} as rf_accuracy,
  {r('coalesce(h.xgb, 0)')} as xgb_accuracy, ([{', '.join(f"'{c}'" for c in FEATURES)}])[t.top + 1] as top_feature
from (select symbol, date, fn from fnum join result_days using (date)) r
left join (select * from st_up where w = 1) t on t.symbol = r.symbol and t.cutoff = r.date
left join (select symbol, cutoff, avg(((round(rf, 9) > 0.5)::int = target)::int) as rf, avg(((round(xgb, 9) > 0.5)::int = target)::int) as xgb
  from st_up where w = 0 group by 1, 2) h on h.symbol = r.symbol and h.cutoff = r.date""", "fnum", "result_days", "st_up"))
def m07_one_split(spark, sf):
    """Probabilities, accuracies and the top input of models of one tree with one split, at the end of every quarter."""
    rows = _one_split(spark, sf)[1]
    return rounded(rows.withColumn("top_feature", F.get("top_features", F.lit(0))).drop("top_features"))


def _one_split(spark, sf):
    """(features, results at the end of every quarter) of models of one tree with one split."""
    features = full_features(spark, sf)
    features = materialize(features.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in FEATURES}))
    return features, ensembles.signals(features, _quarter_ends(features), ensembles.Forest(trees=1, depth=1, offered=len(FEATURES), bootstrap=False),
                                       ensembles.Booster(rounds=1, depth=1, rows=1.0, columns=1.0))


part("st_results", ["fnum", "result_days", "st_up"], """
select r.symbol, r.date, r.fn <= 80 as insufficient, (t.rf + t.xgb)/2 as prob, t.top, h.rf as rf_accuracy, h.xgb as xgb_accuracy, h.n
from (select symbol, date, fn from fnum join result_days using (date)) r
left join (select * from st_up where w = 1) t on t.symbol = r.symbol and t.cutoff = r.date
left join (select symbol, cutoff, avg(((round(rf, 9) > 0.5)::int = target)::int) as rf, avg(((round(xgb, 9) > 0.5)::int = target)::int) as xgb, count(*) as n
  from st_up where w = 0 group by 1, 2) h on h.symbol = r.symbol and h.cutoff = r.date""")


@query("a15_model_accuracy", sql(f"""
select symbol, count(*) as models, {r('avg(rf_accuracy)')} as rf_accuracy, {r('avg(xgb_accuracy)')} as xgb_accuracy, {r('max(rf_accuracy)')} as rf_best
from st_results where not insufficient group by 1""", "st_results"))
def a15_models(spark, sf):
    """Accuracy of the symbols' models on the rows they were fitted without, over all quarters."""
    known = _one_split(spark, sf)[1].filter(~F.col("insufficient"))
    return rounded(known.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("models"), F.avg("rf_accuracy").alias("rf_accuracy"), F.avg("xgb_accuracy").alias("xgb_accuracy"),
        F.max("rf_accuracy").alias("rf_best")))


@query("k05_model_inputs", sql(f"""
select ([{', '.join(f"'{c}'" for c in FEATURES)}])[top + 1] as feature, count(*) as models, count(distinct symbol) as symbols
from st_results where top is not null group by 1""", "st_results"))
def k05_models(spark, sf):
    """The inputs that rank first in the symbols' models, with the number of models each one leads."""
    split = _one_split(spark, sf)[1].filter("size(top_features) > 0")
    return split.groupBy(F.get("top_features", F.lit(0)).alias("feature")).agg(
        F.count(F.lit(1)).alias("models"), F.countDistinct("symbol").alias("symbols"))


@query("m09_model_scores", sql(f"""
select f.symbol, f.date, s.date as scored_on, {r('s.prob')} as prob from fnum f asof left join
  (select symbol, date, coalesce(prob, 0) as prob from st_results) s on s.symbol = f.symbol and s.date <= f.date
where s.date is null or f.date - s.date < 60
union all select f.symbol, f.date, null, null from fnum f asof join (select symbol, date from st_results) s on s.symbol = f.symbol and s.date <= f.date
where f.date - s.date >= 60""", "fnum", "st_results"))
def m09_models(spark, sf):
    """Model scores of quarter ends, each used for less than 60 days."""
    features, rows = _one_split(spark, sf)
    scores = materialize(rows.select("symbol", "date", F.col("ensemble_prob").alias("prob")))
    return rounded(training.reuse_scores(features.select("symbol", "date"), scores, within=60))


@query("m10_model_history", sql(f"""
select f.symbol, f.date, {r('coalesce(s.prob, 0)')} as prob, coalesce(s.prob >= 0.5, false) as signal
from fnum f join result_days using (date) left join st_results s on s.symbol = f.symbol and s.date = f.date and not s.insufficient""",
    "fnum", "result_days", "st_results"))
def m10_models(spark, sf):
    """Quarter ends with the model's score where there was history enough for a model, else probability 0 and no signal."""
    features, rows = _one_split(spark, sf)
    scores = rows.filter(~F.col("insufficient")).select("symbol", "date", F.col("ensemble_prob").alias("prob"))
    found = training.with_insufficient(_quarter_ends(features), scores, replace(RULES, signal_threshold=0.5))
    return rounded(found)


@query("m12_signal_chain")
def m12(spark, sf):
    """Features, models of every symbol fitted anew every fifth day, reuse for less than five days, admission, exits, ledger rows and the sheet's figures."""
    bars = materialize(inputs.bars(spark, sf))
    features = materialize(full_features(spark, sf))
    due = training.retrain_dates(features.select("symbol", "date"), RETRAIN_DAYS)
    scored = materialize(ensembles.signals(features, due)).select("symbol", "date", F.col("ensemble_prob").alias("prob"))
    days = training.reuse_scores(features.select("symbol", "date"), scored, within=RETRAIN_DAYS)
    flow = S.flow_ratio(F.col("taker").cast("double"), F.col("vi").cast("double"))
    cands = materialize(bars.join(days, ["symbol", "date"]).select(
        "date", "symbol", "close", "prob", flow.alias("ofi"), F.lit(False).alias("in_position")))
    state = cands.select("date").distinct().select("date", F.lit(0).alias("n_open"), F.lit(False).alias("halted"), F.lit(RULES.start_balance).alias("balance"))
    logged = admission.admit(cands, state)
    entered = logged.filter("signal_fired").select(
        "symbol", F.col("date").alias("entry_date"), F.col("close").alias("entry_price"), F.col("prob").alias("signal_prob"))
    done = materialize(exits.first_exit(exits.at_entry(entered, exits.with_path(bars))))
    closed = ledger.with_pnl(exits.resolved(done).withColumn("trade_size", F.lit(RULES.trade_size)))
    counts = logged.agg(F.count(F.lit(1)).alias("n_logged"), F.count_if("signal_fired").alias("n_entered"))
    book = ledger.opened(done).agg(F.count(F.lit(1)).alias("n_ledger"))
    # single rows
    return rounded(counts.crossJoin(book).crossJoin(metrics.summary(closed)), avg_pnl_pct=9)
