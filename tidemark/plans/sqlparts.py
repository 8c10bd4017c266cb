"""Common table expressions shared by the SQL side of the registered queries (DuckDB dialect)."""

from __future__ import annotations

# name -> (names it needs, text)
PARTS: dict[str, tuple[list[str], str]] = {}


# parts read by every step of a recursion
HELD = {"next_score"}


def part(name: str, needs: list[str], text: str) -> None:
    PARTS[name] = (needs, text.strip())


def sql(body: str, *names: str):
    """``body`` behind the named parts and everything they need; rendered when all parts are known."""

    def render() -> str:
        ordered: list[str] = []

        def visit(name: str) -> None:
            for need in PARTS[name][0]:
                visit(need)
            if name not in ordered:
                ordered.append(name)

        for name in names:
            visit(name)
        ctes = ",\n".join(f"{n} as {'materialized ' if n in HELD else ''}(\n{PARTS[n][1]}\n)" for n in ordered)
        recursive = "recursive " if "chain" in ordered else ""
        return (f"with {recursive}{ctes}\n" if ctes else "") + body.strip()

    return render


def d(x: float) -> str:
    return f"cast({x} as double)"


def r(expr: str, digits: int = 6) -> str:
    """Rounded, without a negative zero."""
    return f"(round({expr}, {digits}) + cast(0 as double))"


def full(agg: str, x: str, n: int, over: str = "partition by symbol order by date") -> str:
    frame = f"over ({over} rows between {n - 1} preceding and current row)"
    return f"case when count({x}) {frame} = {n} then {agg} {frame} end"


W = "over (partition by symbol order by date)"

part("daily", [], """
select l_returnflag as symbol, cast(l_shipdate as date) as date, count(*) as n,
       sum(cast(round(l_discount*100) as bigint)) as di,
       sum(cast(round(l_tax*100) as bigint)) as ti,
       sum(cast(l_quantity as bigint)) as vi,
       sum(case when l_linestatus = 'O' then cast(l_quantity as bigint) else 0 end) as taker
from lineitem group by 1, 2
""")
part("walk", ["daily"], f"""
select *, round({d(100)} * exp(sum(cast(di as double)/(100*n) - {d(0.05)}) over (partition by symbol order by date
       rows between unbounded preceding and current row)), 8) as close,
       cast(ti as double)/(100*n) * {d(0.10)} as amp
from daily
""")
part("opened", ["walk"], f"""
select *, coalesce(lag(close) {W}, {d(100)}) * (1 + (((n + vi) % 5) - 2) * {d(0.002)}) as open
from walk
""")
part("bars", ["opened"], f"""
select symbol, date, open, greatest(open, close)*(1+amp) as high, least(open, close)*(1-amp) as low, close,
       cast(vi as double) as volume, row_number() {W} as rn, cast(vi as bigint) as vi, cast(taker as bigint) as taker
from opened
""")
part("bbars", ["bars"], f"""
select * exclude (rn), row_number() {W} as rn from bars where isodow(date) <= 5
""")
part("flow", ["bars"], """
select symbol, date, (2.0::double*taker - vi)/vi as ofi from bars where vi > 0
""")
part("sentiment", [], """
select cast(o_orderdate as date) as date,
       cast(floor(100 * cast(count(*) filter (o_orderpriority in ('1-URGENT','2-HIGH')) as double)/count(*)) as integer) as value
from orders where isodow(o_orderdate) <= 5 group by 1
""")
part("fgs", ["bars", "sentiment"], """
select b.*, cast(coalesce(last_value(s.value ignore nulls) over (partition by b.symbol order by b.date
       rows between unbounded preceding and current row), 50) as double) as fg
from bars b left join sentiment s on b.date = s.date
""")
part("delta", ["bars"], f"""
select *, close - lag(close) {W} as delta from bars
""")
part("gains", ["delta"], f"""
select *, {full('avg(case when delta is not null then greatest(delta, 0) end)', 'delta', 14)} as ag,
       {full('avg(case when delta is not null then greatest(-delta, 0) end)', 'delta', 14)} as al
from delta
""")
part("rsi", ["gains"], """
select *, 100 - 100/(1 + ag/nullif(al, 0)) as rsi from gains
""")
part("ranges", ["bars"], f"""
select *, greatest(high - low, abs(high - lag(close) {W}), abs(low - lag(close) {W})) as tr from bars
""")
part("atr", ["ranges"], f"""
select *, {full('avg(tr)', 'tr', 14)} as atr, ({full('avg(tr)', 'tr', 14)})/close as atr_pct from ranges
""")
part("regime", ["atr"], f"""
select *, (atr_pct - {full('avg(atr_pct)', 'atr_pct', 60)}) / nullif({full('stddev_samp(atr_pct)', 'atr_pct', 60)}, 0) as atr_pct_z,
       cast(coalesce(atr_pct > {full('quantile_cont(atr_pct, 0.75)', 'atr_pct', 60)}, false) as integer) as high_vol_regime
from atr
""")


def ema_sql(span: int, terms: int = 1200) -> str:
    """The exponential mean as a weighted sum over past bars."""
    a = f"(cast(2 as double)/{span + 1})"
    return f"""
select t.symbol, t.date, sum(x.close * power(1-{a}, t.rn - x.rn) * case when x.rn = 1 then 1 else {a} end) as ema{span}
from bars t join bars x on x.symbol = t.symbol and x.rn between t.rn - {terms} and t.rn group by 1, 2
"""


part("ema20", ["bars"], ema_sql(20))
part("ema50", ["bars"], ema_sql(50))
part("ema", ["bars", "ema20", "ema50"], """
select b.*, ema20, ema50, close/ema20 - 1 as price_ema20_ratio, close/ema50 - 1 as price_ema50_ratio,
       ema20/ema50 - 1 as ema20_ema50_ratio
from bars b join ema20 using (symbol, date) join ema50 using (symbol, date)
""")
part("bands", ["bars"], f"""
select *, {full('avg(close)', 'close', 20)} as sma, {full('stddev_samp(close)', 'close', 20)} as sd from bars
""")
part("pos", ["rsi"], """
select symbol, date as entry_date, close as entry_price, high as entry_high, rn as entry_rn,
       (vi % 100)/100.0::double as signal_prob, (2.0::double*taker - vi)/vi as ofi
from rsi where rsi < 35
""")


def exits_parts(prefix: str = "", positions: str = "pos", source: str = "bars", tp: str = "0.03", sl: str = "0.01",
                trig: str = "0.015", extra: str = "", seed: str | None = None, plain: str | None = None) -> None:
    """Register ``{prefix}path``, ``{prefix}armed``, ``{prefix}hits`` and ``{prefix}exits``. ``extra`` names
    more key columns of the positions (a parameter id)."""
    TP, SL, TR = (f"cast({x} as double)" for x in (tp, sl, trig))
    key = f"symbol, entry_date{extra}"
    seeded = seed or f"entry_high >= entry_price*(1 + {TR})"
    stop = plain or f"entry_price*(1 - {SL})"
    pct = f"-{SL}" if plain is None else f"({plain} - entry_price)/entry_price"
    part(f"{prefix}path", [positions, source], f"""
select p.*, b.date, b.open, b.high, b.low, b.close, b.rn - p.entry_rn as k, date_diff('day', p.entry_date, b.date) as hold
from {positions} p join {source} b on b.symbol = p.symbol and b.rn between p.entry_rn + 1 and p.entry_rn + 7
""")
    part(f"{prefix}armed", [f"{prefix}path"], f"""
select *, {seeded} or coalesce(bool_or(high >= entry_price*(1 + {TR})) over (partition by {key} order by k
       rows between unbounded preceding and 1 preceding), false) as armed
from {prefix}path
""")
    part(f"{prefix}hits", [f"{prefix}armed"], f"""
select *, case when high >= entry_price*(1 + {TP}) then 'TP'
               when armed and low <= entry_price*(1 + {TR}) then 'TRAIL_BE'
               when not armed and low <= entry_price*(1 - {SL}) then 'SL'
               when hold >= 5 then 'MAX_HOLD' end as reason
from {prefix}armed
""")
    part(f"{prefix}exits", [f"{prefix}hits"], f"""
select {key}, entry_price, signal_prob, ofi, date as exit_date, reason,
       case reason when 'TP' then entry_price*(1 + {TP}) when 'SL' then {stop}
                   when 'TRAIL_BE' then least(entry_price*(1 + {TR}), open) else close end as exit_price,
       case reason when 'TP' then {TP} when 'SL' then {pct}
                   when 'TRAIL_BE' then (least(entry_price*(1 + {TR}), open) - entry_price)/entry_price
                   else (close - entry_price)/entry_price end as pnl_pct,
       cast(hold as integer) as hold_days, open as exit_open
from {prefix}hits where reason is not null
qualify row_number() over (partition by {key} order by k) = 1
""")


exits_parts()


def trades_part(name: str, source: str, scale: float = 1.0) -> None:
    size = f"(cast(10000 as double)*{d(0.01)}/3*{d(scale)})"
    part(name, [source], f"""
select *, {size} as trade_size, pnl_pct*{size} as pnl_gross, {size}*{d(0.0026)}*2 as fees,
       pnl_pct*{size} - {size}*{d(0.0026)}*2 as pnl_net, pnl_pct*{size} - {size}*{d(0.0026)}*2 > 0 as win
from {source}
""")


trades_part("trades", "exits")
trades_part("trades10", "exits", 10.0)
part("calendar", ["bars"], "select distinct date from bars")


def equity_part(name: str, source: str) -> None:
    part(name, ["calendar", source], f"""
select c.date, {d(10000)} + sum(coalesce(t.net, 0)) over (order by c.date rows between unbounded preceding and current row) as balance
from calendar c left join (select exit_date, sum(pnl_net) as net from {source} group by 1) t on t.exit_date = c.date
""")


equity_part("equity", "trades")
equity_part("equity10", "trades10")
part("cands", ["bars"], """
select date, symbol, close, (vi % 100)/100.0::double as prob, (2.0::double*taker - vi)/vi as ofi, vi % 7 = 0 as in_position
from bars
""")
part("daystate", ["cands"], """
select distinct date, day(date) % 4 as n_open, month(date) = 12 as halted, cast(10000 as double) as balance from cands
""")
part("live", ["trades"], """
select * replace (case when day(entry_date) = 1 then 'SL' else reason end as reason)
from trades where isodow(entry_date) <= 5
""")
