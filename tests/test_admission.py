import datetime as dt
import random

import pytest

from tidemark.operators import admission
from tidemark.params import RULES

CAND = "date date, symbol string, close double, prob double, ofi double, in_position boolean"
DAYS = "date date, n_open int, halted boolean, balance double"


def plain_walk(cands, day):
    """One day by a loop."""
    n_open, log = day["n_open"], []
    for c in sorted(cands, key=lambda c: (-c["prob"], c["symbol"])):
        size = day["balance"] * RULES.risk_per_trade / RULES.max_positions
        if day["halted"]:
            log.append((c["symbol"], "KILL_SWITCH_HALTED"))
            continue
        if n_open >= RULES.max_positions:
            log.append((c["symbol"], "MAX_POSITIONS"))
            break
        if c["in_position"]:
            log.append((c["symbol"], "ALREADY_IN_POS"))
        elif c["prob"] < RULES.signal_threshold:
            log.append((c["symbol"], f"PROB_TOO_LOW_{c['prob']:.4f}"))
        elif c["ofi"] <= 0:
            log.append((c["symbol"], f"OFI_NEGATIVE_{c['ofi']:+.4f}"))
        elif size < RULES.min_order:
            log.append((c["symbol"], "MIN_ORDER_SIZE"))
        else:
            log.append((c["symbol"], "NONE"))
            n_open += 1
    return set(log)


@pytest.mark.parametrize("seed", [1, 2])
def test_admission_matches_a_walk(spark, seed):
    rng = random.Random(seed)
    cands, days = [], []
    for i in range(60):
        date = dt.date(2024, 1, 1) + dt.timedelta(days=i)
        days.append((date, rng.randint(0, 4), rng.random() < 0.15, rng.choice([10000.0, 1000.0])))
        for k in range(rng.randint(1, 40 if i % 10 else 400)):  # some days hold most of the rows
            cands.append((date, f"S{k:03d}", 100.0, rng.choice([0.0, 0.5, 0.6, 0.65, round(rng.random(), 2)]),
                          rng.choice([-0.25, 0.0, 0.5]), rng.random() < 0.2))
    got = admission.admit(spark.createDataFrame(cands, CAND), spark.createDataFrame(days, DAYS)).collect()
    for date, n_open, halted, balance in days:
        mine = [dict(zip(("date", "symbol", "close", "prob", "ofi", "in_position"), c)) for c in cands if c[0] == date]
        want = plain_walk(mine, {"n_open": n_open, "halted": halted, "balance": balance})
        assert {(r["symbol"], r["reject_reason"]) for r in got if r["date"] == date} == want


def test_forced_size(spark):
    rows = admission.admit(
        spark.createDataFrame([(dt.date(2024, 1, 1), "A", 10.0, 0.9, 0.1, False)], CAND),
        spark.createDataFrame([(dt.date(2024, 1, 1), 0, False, 10000.0)], DAYS)).collect()
    assert rows[0]["reject_reason"] == "NONE" and rows[0]["trade_size"] == pytest.approx(33.3333, abs=1e-4)


def test_the_plan_cuts_entries_before_the_shuffle(spark):
    cands = spark.createDataFrame([(dt.date(2024, 1, 1), "A", 10.0, 0.9, 0.1, False)], CAND)
    days = spark.createDataFrame([(dt.date(2024, 1, 1), 0, False, 10000.0)], DAYS)
    plan = admission.admit(cands, days)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_extended_names_insufficient_data(spark):
    cands = spark.createDataFrame([(dt.date(2024, 1, 1), "A", 10.0, 0.0, 0.1, False, True), (dt.date(2024, 1, 1), "B", 10.0, 0.0, 0.1, False, False)],
                                  CAND + ", insufficient boolean")
    days = spark.createDataFrame([(dt.date(2024, 1, 1), 0, False, 10000.0)], DAYS)
    assert {r["reject_reason"] for r in admission.admit(cands, days).collect()} == {"PROB_TOO_LOW_0.0000"}
    rows = {r["symbol"]: r["reject_reason"] for r in admission.admit(cands, days, extended=True).collect()}
    assert rows == {"A": "INSUFFICIENT_DATA", "B": "PROB_TOO_LOW_0.0000"}


def test_unknowns_close_the_gate(spark):
    day = dt.date(2024, 1, 1)
    nan = float("nan")
    cands = [(day, "A", 10.0, None, 0.1, False), (day, "B", 10.0, 0.9, None, False), (day, "C", 10.0, nan, 0.1, False), (day, "D", 10.0, 0.9, nan, False),
             (day, "E", 10.0, 0.9, 0.1, None)]
    rows = {r["symbol"]: r for r in admission.admit(spark.createDataFrame(cands, CAND), spark.createDataFrame([(day, 0, False, 10000.0)], DAYS)).collect()}
    assert rows["A"]["reject_reason"] == "PROB_TOO_LOW_0.0000" and rows["B"]["reject_reason"] == "OFI_NEGATIVE_+0.0000"
    assert {k for k, r in rows.items() if r["signal_fired"]} == {"E"} and len(rows) == 5


@pytest.mark.parametrize("state", [[], [(None, False, 10000.0)], [(0, None, 10000.0)], [(0, False, None)]])
def test_a_day_without_state_is_logged_and_enters_nothing(spark, state):
    day, other = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    cands = [(d, s, 10.0, 0.9, 0.1, False) for d in (day, other) for s in "ABCDE"]
    days = [(day, *s) for s in state] + [(other, 0, False, 10000.0)]
    rows = admission.admit(spark.createDataFrame(cands, CAND), spark.createDataFrame(days, DAYS)).collect()
    assert {r["symbol"]: r["reject_reason"] for r in rows if r["date"] == day} == dict.fromkeys("ABCDE", admission.NO_STATE)
    assert [r["reject_reason"] for r in sorted(rows, key=lambda r: r["symbol"]) if r["date"] == other] == ["NONE"] * 3 + ["MAX_POSITIONS"]


def test_two_states_for_a_day(spark):
    day = dt.date(2024, 1, 1)
    cands = spark.createDataFrame([(day, "A", 10.0, 0.9, 0.1, False)], CAND)
    same = spark.createDataFrame([(day, 0, False, 10000.0)] * 2, DAYS)
    assert admission.admit(cands, same).first()["reject_reason"] == "NONE"
    for other in ((day, 1, False, 10000.0), (day, 0, True, 10000.0), (day, None, False, 10000.0)):
        with pytest.raises(Exception, match="two account states"):
            admission.admit(cands, spark.createDataFrame([(day, 0, False, 10000.0), other], DAYS)).collect()
