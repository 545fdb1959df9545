"""Daily series per key: filled days and statistics of the days before."""

from __future__ import annotations

from datetime import date, timedelta
from statistics import mean, stdev

import pytest
from tradewind.config import AnomalySettings
from tradewind.functions.series import fill_days, rolling
from tradewind.operators import marts

SCHEMA = "state string, day date, n int, m int"


def day(i: int) -> date:
    return date(2018, 1, 1) + timedelta(days=i)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_each_key_is_filled_between_its_own_ends(frame):
    df = frame(SCHEMA, ("a", day(0), 3, 1), ("a", day(3), 4, None), ("b", day(2), 5, 0), (None, day(5), 1, 1), (None, day(6), 2, 0))
    got = rows_of(fill_days(df, "day", ["n", "m"], ["state"]), "state", "day", "n", "m")
    want = [("a", day(0), 3, 1), ("a", day(1), 0, 0), ("a", day(2), 0, 0), ("a", day(3), 4, 0), ("b", day(2), 5, 0)]
    assert got == sorted([*want, (None, day(5), 1, 1), (None, day(6), 2, 0)], key=str)


def test_a_shared_calendar_runs_from_the_first_to_the_last_day_of_all(frame):
    df = frame(SCHEMA, ("a", day(1), 3, 1), ("b", day(0), 5, 0), ("b", day(4), 1, 0))
    got = rows_of(fill_days(df, "day", ["n"], ["state"], shared=True), "state", "day", "n")
    assert got == sorted([("a", day(i), 3 if i == 1 else 0) for i in range(5)] + [("b", day(i), {0: 5, 4: 1}.get(i, 0)) for i in range(5)], key=str)


def test_rows_without_a_day_and_empty_tables(frame):
    df = frame(SCHEMA, ("a", None, 3, 1), ("b", day(0), 5, 0))
    assert rows_of(fill_days(df, "day", ["n"], ["state"]), "state", "day", "n") == [("b", day(0), 5)]
    for shared in (False, True):
        assert fill_days(df.where("false"), "day", ["n"], ["state"], shared=shared).count() == 0
        assert fill_days(df.where("false"), "day", ["n"], shared=shared).count() == 0


@pytest.mark.parametrize("days", [1, 3, 7])
def test_rolling_statistics_of_each_key(frame, days):
    series = {"a": [5, 5, 5, 9, 1, 0, 7, 7, 40, 2], "b": [1, 2, 4, 8], None: [3, 3, 3, 3, 3, 3, 3, 3, 9]}
    df = frame("state string, day date, n int", *[(k, day(i), n) for k, ns in series.items() for i, n in enumerate(ns)])
    got = {(r.state, r.day): r for r in rolling(df, "n", "day", days, ["state"]).collect()}
    for key, numbers in series.items():
        for i, n in enumerate(numbers):
            before = numbers[max(0, i - days) : i]
            row = got[key, day(i)]
            if len(before) < days:
                assert row.rolling_mean is row.rolling_std is row.z_score is None
                continue
            spread = stdev(before) if days > 1 else None
            assert row.rolling_mean == pytest.approx(mean(before))
            assert row.rolling_std == (pytest.approx(spread) if spread is not None else None)
            assert row.z_score == (pytest.approx((n - mean(before)) / spread) if spread else None)


def test_an_anomaly_of_one_state_stays_in_its_series(frame):
    counts = {"a": [10, 11, 9, 10, 60], "b": [10, 11, 9, 10, 10]}
    rows = [(f"{s}{i}{j}", day(i), 0, s) for s, ns in counts.items() for i, n in enumerate(ns) for j in range(n)]
    orders = frame("order_id string, order_purchase_date date, is_canceled int, customer_state string", *rows)
    got = marts.mart_daily_order_anomalies(orders, AnomalySettings(3, 3.0), ("customer_state",)).collect()
    assert [(r.customer_state, r.order_date, r.anomaly_direction) for r in got if r.is_anomaly] == [("a", day(4), "spike")]
    alone = marts.mart_daily_order_anomalies(orders.where("customer_state = 'b'"), AnomalySettings(3, 3.0)).collect()
    ours = [r for r in got if r.customer_state == "b"]
    assert [tuple(r) for r in alone] == sorted(tuple(r)[1:] for r in ours)


def test_a_silent_state_drops_on_the_shared_calendar(frame):
    rows = [(f"{s}{i}{j}", day(i), 0, s) for s, n in (("a", 10), ("b", 6)) for i in range(6) for j in range(n + i % 2)]
    orders = frame("order_id string, order_purchase_date date, is_canceled int, customer_state string", *rows)
    left = orders.where(f"customer_state = 'a' OR order_purchase_date < DATE'{day(5)}'")
    own = marts.mart_daily_order_anomalies(left, AnomalySettings(3, 3.0), ("customer_state",))
    both = marts.mart_daily_order_anomalies(left, AnomalySettings(3, 3.0), ("customer_state",), shared_calendar=True)
    assert own.where("is_anomaly = 1").count() == 0
    assert rows_of(both.where("is_anomaly = 1"), "customer_state", "order_date", "anomaly_direction") == [("b", day(5), "drop")]


def test_filling_and_windows_share_one_distribution(frame):
    rows = [(f"{i}", day(i), 0, "a") for i in range(5)]
    orders = frame("order_id string, order_purchase_date date, is_canceled int, customer_state string", *rows).repartition(3)
    plan = marts.mart_daily_order_anomalies(orders, AnomalySettings(3, 3.0), ("customer_state",))
    text = plan._jdf.queryExecution().executedPlan().toString()
    # One exchange for the counts per key and day, one by key for the filled series and its windows.
    assert text.count("Exchange hashpartitioning") == 2 and "Join" not in text
