"""Player features."""

import pytest
from conftest import by
from pyspark.sql import functions as F

from wagerscope.operators import players, rows


def test_chase_factor_is_strict_and_first_bet_has_no_predecessor(make_tx):
    amounts = [10, 12, 12.01, 20]
    tx = make_tx(
        [("p", "s", f"2024-01-01 10:0{i}:00", "G001", a, 0) for i, a in enumerate(amounts)]
    )
    row = players.bet_escalation(tx).first()
    assert row.chasing_incidents == 1  # only 20 > 1.2 * 12.01
    grown = (2 / 10 + 0.01 / 12 + 7.99 / 12.01) / 4
    assert row.avg_bet_increase_after_loss == pytest.approx(grown)


def test_escalation_stays_inside_sessions(make_tx):
    tx = make_tx(
        [("p", "s1", "2024-01-01 10:00:00", "G001", 10, 0), ("p", "s2", "2024-01-01 10:01:00", "G001", 90, 0)]
    )
    assert players.bet_escalation(tx).first().chasing_incidents == 0


def test_mode_takes_the_smallest_on_a_tie(make_tx):
    tx = make_tx([("p", "s", f"2024-01-02 {h}:00:00", "G001", 1, 0) for h in ("09", "14", "14", "09")])
    row = players.most_common_times(tx).first()
    assert (row.most_common_hour, row.most_common_day) == (9, 1)


def test_single_bet_player(make_tx):
    tx = make_tx([("p", "s", "2024-01-02 09:00:00", "G001", 5, 0)])
    base = players.player_base(tx).first()
    assert (base.stddev_bet_amount, base.days_active_span, base.total_sessions) == (0.0, 0, 1)
    summary = players.player_summary(tx).first()
    assert (summary.bet_volatility, summary.days_active, summary.avg_daily_value) == (None, 1, 5.0)
    assert players.training_features(tx).count() == 0
    assert players.training_features(tx, min_bets=1, min_days=1).count() == 1


def test_recency_windows_include_their_first_day(make_tx):
    days = ["2024-01-01", "2024-01-02", "2024-01-25", "2024-01-24"]
    tx = make_tx(
        [("p", d, f"{d} 10:00:00", "G001", 1, 0) for d in days]
        + [("q", "q", "2024-02-01 10:00:00", "G001", 1, 0)]
    )
    row = by(players.recency_features(tx), "player_id")["p"]
    assert row["days_since_last_bet"] == 7
    assert row["active_days_last_7d"] == 1
    assert row["active_days_last_30d"] == 3
    assert row["pct_days_active_in_period"] == pytest.approx(4 / 32)


def test_session_extremes_follow_the_mode(make_tx):
    tx = make_tx(
        [
            ("p", "s1", "2024-01-01 10:00:00", "G001", 10, 0),
            ("p", "s1", "2024-01-01 10:01:00", "G001", 10, 40),
            ("p", "s2", "2024-01-02 10:00:00", "G001", 10, 15),
            ("p", "s2", "2024-01-02 10:01:00", "G001", 10, 0),
        ]
    )

    def extremes(mode):
        r = players.session_features(tx, mode).first()
        return r.worst_session_balance, r.best_session_result

    assert extremes("low_and_result") == (-10.0, 20.0)
    assert extremes("peak") == (5.0, 20.0)
    assert extremes("closing") == (-5.0, 20.0)


def test_risk_score_limits_are_strict(spark):
    df = spark.createDataFrame(
        [("low", 100.0, 10000.0, 5, 10, 1.0), ("high", 100.01, 10000.01, 6, 11, 1.01)],
        "p string, avg_bet_amount double, total_net_loss double, max_consecutive_losses int, "
        "chasing_incidents int, bet_cv double",
    )
    got = {r.p: r.s for r in df.select("p", players.risk_score().alias("s")).collect()}
    assert got == {"low": 0, "high": 8}


def test_churn_flag_needs_more_than_the_limit(make_tx):
    tx = make_tx(
        [
            ("edge", "s", "2024-01-01 10:00:00", "G001", 1, 0),
            ("gone", "t", "2023-12-31 10:00:00", "G001", 1, 0),
            ("last", "u", "2024-03-01 10:00:00", "G001", 1, 0),
        ]
    )
    out = by(players.with_churn_flag(players.player_summary(tx), tx), "player_id")
    assert not out["edge"]["is_churned"] and out["edge"]["churn_date"] is None
    assert out["gone"]["is_churned"] and str(out["gone"]["churn_date"]) == "2023-12-31"


def test_minimum_activity(spark):
    df = spark.createDataFrame([(10, 2), (9, 2), (10, 1)], "total_bets int, active_days int")
    assert [tuple(r) for r in rows.minimum_activity(df).collect()] == [(10, 2)]


def test_training_joins_stay_on_one_key(spark, make_tx):
    tx = make_tx([("p", "s", "2024-01-02 09:00:00", "G001", 5, 0)])
    plan = players.training_features(tx)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert players.training_features(tx).agg(F.count("*")).first()[0] == 0
