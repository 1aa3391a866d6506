"""Segment dashboards and distributions."""

import pytest
from conftest import by
from pyspark.sql import functions as F

from wagerscope.operators import dashboards
from wagerscope.sources import adapters

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(make_tx):
    return make_tx(
        [
            ("a", "a1", "2024-01-01 10:00:00", "G001", 10, 0),
            ("a", "a1", "2024-01-01 10:01:00", "G002", 10, 30),
            ("b", "b1", "2024-01-01 10:00:00", "G001", 40, 0),
            ("b", "b2", "2024-02-20 10:00:00", "G001", 5, 0),
        ]
    )


@pytest.fixture(scope="module")
def seg(spark):
    return spark.createDataFrame(
        [("a", "VIP"), ("b", "VIP"), ("idle", "Casual")], "player_id string, player_segment string"
    )


def test_revenue_level_changes_the_result(small, seg):
    per_player = by(dashboards.daily_by_segment(small, seg), "date")
    per_day = by(dashboards.daily_by_segment(small, seg, ggr_level="segment_day"), "date")
    first = min(per_player)
    assert per_player[first]["total_ggr"] == 40.0  # a won, so only b's loss counts
    assert per_day[first]["total_ggr"] == 30.0  # the segment's own result


def test_snapshot_keeps_idle_segments(small, seg):
    out = by(dashboards.segment_snapshot(small, seg), "player_segment")
    assert (out["Casual"]["player_count"], out["Casual"]["wagered_30d"], out["Casual"]["ggr_30d"]) == (1, 0.0, 0.0)
    assert (out["VIP"]["wagered_30d"], out["VIP"]["pct_of_total_ggr"]) == (5.0, 100.0)


def test_risk_counts_players_once(make_tx, spark):
    tx = make_tx(
        [("a", "s", f"2024-01-01 10:0{i}:00", "G001", 300, 0) for i in range(6)]
        + [("b", "t", "2024-01-01 10:00:00", "G001", 1, 0)]
    )
    seg = spark.createDataFrame([("a", "X"), ("b", "X")], "player_id string, player_segment string")
    row = dashboards.risk_indicators(tx, seg).first()
    assert (row.players_with_long_losing_streaks, row.players_with_large_session_losses) == (1, 1)
    assert row.pct_high_risk_players == 50.0
    assert row.avg_consecutive_losses == pytest.approx((21 + 1) / 7)


def test_game_shares_sum_to_hundred(spark):
    seg = adapters.market_segments(spark, SF)
    out = dashboards.game_preference(adapters.ledger(spark, SF), seg, days=400)
    for r in out.groupBy("player_segment").agg(F.sum("pct_of_segment_bets").alias("s")).collect():
        assert r.s == pytest.approx(100)


def test_pareto_with_many_equal_players(make_tx):
    bets = [(f"p{i}", "s", "2024-01-01 10:00:00", "G001", 10, 0) for i in range(40)]
    bets += [("big", "s", "2024-01-01 10:00:00", "G001", 600, 0)]
    got = sorted((r.player_pct, r.cumulative_pct) for r in dashboards.pareto_curve(make_tx(bets)).collect())
    want = [((i + 1) / 41 * 100, (600 + 10 * i) / 10) for i in range(41)]
    assert got == [pytest.approx(w) for w in want]


def test_histogram_counts_everything_once(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    got = by(dashboards.histogram(df, "v", 10), "bin")
    assert sum(r["count"] for r in got.values()) == 101
    assert got[9]["count"] == 11 and got[9]["bin_end"] == pytest.approx(100)
    same = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [(r.bin, r["count"]) for r in dashboards.histogram(same, "v", 5).collect()] == [(0, 2)]


def test_lognormal_fit_ignores_zero_bets(make_tx):
    tx = make_tx([("a", "s", f"2024-01-01 10:0{i}:00", "G001", b, 0) for i, b in enumerate([0, 1, 1, 1])])
    row = dashboards.lognormal_fit(tx).first()
    assert (row.mu, row.sigma) == (0.0, 0.0)


def test_persona_bet_spread_equals_plain_percentiles(spark):
    tx = adapters.ledger(spark, SF)
    lab = adapters.market_segments(spark, SF).withColumnRenamed("player_segment", "label")
    got = by(dashboards.bet_spread_by_persona(tx, lab), "label")
    plain = tx.join(lab, "player_id").groupBy("label").agg(
        *[F.percentile(F.col("bet_amount"), p).alias(n) for n, p in dashboards.LETTER_VALUES.items()]
    )
    for label, row in by(plain, "label").items():
        for name in dashboards.LETTER_VALUES:
            assert got[label][name] == pytest.approx(row[name])
