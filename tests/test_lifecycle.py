"""Acquisition, retention, churn and value."""

import pytest
from conftest import by
from pyspark.sql import functions as F

from wagerscope.operators import lifecycle
from wagerscope.sources import adapters

SF = "/root/testdata/sf0.001"


def _play(make_tx, plan):
    """One 10-unit losing bet per (player, day)."""
    return make_tx(
        [(p, f"{p}{d}", f"{d} 10:00:00", "G001", 10, 0) for p, days in plan.items() for d in days]
    )


def test_cohorts_and_month_index(make_tx):
    tx = _play(make_tx, {"a": ["2024-01-31", "2024-02-01", "2024-03-01"], "b": ["2024-01-05", "2024-03-31"]})
    exact = by(lifecycle.cohort_retention(tx), "months_since_acquisition")
    assert {k: (r["active_players"], r["retention_pct"]) for k, r in exact.items()} == {
        0: (2, 100.0), 1: (1, 50.0), 2: (2, 100.0)
    }
    days = by(lifecycle.cohort_retention(tx, mode="days_30_44"), "months_since_acquisition")
    assert {k: r["active_players"] for k, r in days.items()} == {0: 2, 1: 2}  # 60 days -> 1


def test_first_month_is_always_complete(spark):
    got = lifecycle.cohort_matrix(adapters.ledger(spark, SF))
    assert got.where("month_0 <> 100").count() == 0


def test_first_activity_breaks_ties_by_transaction(make_tx):
    tx = make_tx(
        [("a", "s", "2024-01-01 10:00:00", "G002", 7, 0), ("a", "s", "2024-01-01 10:00:00", "G001", 9, 0)]
    )
    row = lifecycle.first_activity(tx).first()
    assert (row.first_game_played, float(row.first_bet_amount)) == ("G002", 7.0)


def test_lost_players_are_clamped_and_zero_in_the_first_month(make_tx):
    tx = _play(
        make_tx,
        {"a": ["2024-01-01", "2024-02-01"], "b": ["2024-01-02", "2024-03-01"], "c": ["2024-03-05"]},
    )
    months = lifecycle.monthly_lifecycle(tx).collect()
    assert [r.churned_players for r in months] == [0, 1, 0]
    assert [r.net_growth for r in months] == [2, -1, 1]
    raw = lifecycle.monthly_churn(tx).collect()
    assert [r.churned_players for r in raw] == [None, 1, -1]


def test_churn_status_limits(make_tx):
    tx = _play(
        make_tx,
        {
            "now": ["2024-12-31"], "d30": ["2024-12-01"], "d31": ["2024-11-30"],
            "d60": ["2024-11-01"], "d90": ["2024-10-02"], "d91": ["2024-10-01"],
        },
    )
    got = [(r.churn_status, r.player_count) for r in lifecycle.churn_status(tx).collect()]
    assert got == [
        ("Active", 2), ("At Risk", 2), ("Churned (Recent)", 1), ("Churned (Long-term)", 1)
    ]


def test_window_retention_first_day_option(make_tx):
    tx = _play(make_tx, {"a": ["2024-01-01"], "b": ["2024-01-01", "2024-01-31"], "z": ["2024-12-01"]})
    plain = lifecycle.window_retention(tx).first()
    later = lifecycle.window_retention(tx, exclude_first_day=True).first()
    assert (plain.total_players, plain.retention_30d_pct, plain.reactivation_30_60d_pct) == (2, 100.0, 50.0)
    assert later.retention_30d_pct == 50.0


def test_pre_churn_window_and_missing_segment(spark, make_tx):
    tx = _play(make_tx, {"a": ["2024-01-01", "2024-01-31", "2024-03-01"], "z": ["2024-12-01"]})
    seg = spark.createDataFrame([("z", "VIP")], "player_id string, player_segment string")
    row = lifecycle.pre_churn_behaviour(tx, seg).first()
    assert row.player_segment is None
    assert row.avg_bets_before_churn == 2.0  # 2024-01-31 is 30 days before 2024-03-01


def test_base_churn_fills_empty_months(spark, make_tx):
    tx = _play(make_tx, {"a": ["2024-01-01", "2024-03-01"], "b": ["2024-02-01"]})
    seg = spark.createDataFrame([("a", "VIP"), ("b", "Casual")], "player_id string, player_segment string")
    out = by(lifecycle.base_churn(tx, seg), "player_segment", "month")
    vip = [out[k]["churned"] for k in sorted(out) if k[0] == "VIP"]
    assert vip == [1, -1]
    assert [out[k]["churn_rate_pct"] for k in sorted(out) if k[0] == "VIP"] == [100.0, 0.0]


def test_ltv_is_at_least_first_month_revenue(spark):
    tx = adapters.ledger(spark, SF)
    for r in lifecycle.cohort_ltv(tx).collect():
        assert r.ltv_12m >= r.month_0_arpu
    total = lifecycle.cohort_ltv(tx).agg(F.sum("ltv_12m")).first()[0]
    each = lifecycle.cohort_ltv(tx, per_player=True).agg(F.sum("ltv_12m")).first()[0]
    assert each < total


def test_weekly_table_counts_leavers_in_their_last_week(make_tx):
    tx = _play(make_tx, {"a": ["2024-01-02"], "b": ["2024-01-10"], "z": ["2024-06-03"]})
    out = lifecycle.weekly_churn(tx).orderBy("week").collect()
    assert [(r.churned_cumulative, r.active_players) for r in out[:3]] == [(1, 2), (2, 1), (2, 1)]
    assert str(out[0].date) == "2024-01-01" and out[-1].churned_cumulative == 2


def test_composition_sums_to_hundred(spark):
    seg = adapters.market_segments(spark, SF)
    names = [r[0] for r in seg.select("player_segment").distinct().collect()]
    out = lifecycle.base_composition(adapters.ledger(spark, SF), seg, names)
    for r in out.collect():
        assert sum(r[n] or 0 for n in names) == pytest.approx(100)


def test_retention_weighted_value(spark, make_tx):
    tx = _play(make_tx, {"a": ["2024-01-01", "2024-02-01"], "b": ["2024-01-02"]})
    lab = spark.createDataFrame([("a", "L"), ("b", "L")], "player_id string, label string")
    row = lifecycle.retention_weighted_ltv(tx, lab, acquisition_cost=5).first()
    assert (row.month_0_arpu, row.retained_months, row.ltv_12m) == (10.0, 1.5, 15.0)
    assert row.roi_pct == pytest.approx(200)
