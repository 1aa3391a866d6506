"""Daily tables and their window features."""

import pytest
from conftest import by
from pyspark.sql import functions as F

from wagerscope.operators import daily
from wagerscope.sources import adapters

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def gap_days(make_tx):
    """New players on days 1 and 4; day 2 has play but nobody new."""
    return make_tx(
        [
            ("a", "a1", "2024-01-01 10:00:00", "G001", 10, 0),
            ("b", "b1", "2024-01-01 11:00:00", "G001", 10, 30),
            ("a", "a2", "2024-01-02 10:00:00", "G001", 5, 0),
            ("c", "c1", "2024-01-04 10:00:00", "G001", 8, 0),
        ],
        sequence=False,
    )


def test_cumulative_base_is_zero_without_new_players(spark, gap_days):
    games = adapters.games(spark)
    plain = by(daily.daily_game_aggregate(gap_days, games), "date")
    carried = by(daily.daily_game_aggregate(gap_days, games, carry_forward=True), "date")
    assert [r["cumulative_player_base"] for _, r in sorted(plain.items())] == [2, 0, 3]
    assert [r["cumulative_player_base"] for _, r in sorted(carried.items())] == [2, 2, 3]
    first = min(plain.items())[1]
    assert (first["daily_ggr"], first["gross_gaming_revenue"], first["hold_percentage"]) == (-10, 10, -50)


def test_lags_count_rows_not_days(spark, gap_days):
    out = daily.lag_features(daily.daily_game_aggregate(gap_days, adapters.games(spark)))
    assert [r.ggr_lag1 for r in out.orderBy("date").collect()] == [None, -10.0, 5.0]


def test_min_periods_blank_partial_windows(spark):
    days = spark.range(8).select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        F.lit("G001").alias("game_id"),
        F.col("id").cast("double").alias("daily_ggr"),
        F.col("id").cast("double").alias("total_wagered"),
        F.col("id").alias("daily_active_users"),
        F.col("id").alias("total_bets"),
    )
    part = [r.ggr_ma7 for r in daily.moving_averages(days).orderBy("date").collect()]
    full = [r.ggr_ma7 for r in daily.moving_averages(days, min_periods=7).orderBy("date").collect()]
    assert part[0] == 0.0 and part[7] == 4.0
    assert full[:6] == [None] * 6 and full[6] == 3.0
    spread = [r.ggr_std7 for r in daily.moving_deviations(days).orderBy("date").collect()]
    assert spread[0] is None


def test_hold_against_expectation_guards(spark):
    row = "DATE'2024-01-01' date, 5D hold_percentage, 1D daily_ggr, 1L daily_active_users, 1D total_wagered, 1L total_bets, 1L total_sessions"
    df = spark.sql(f"SELECT {row}, explode(array(0D, 1D, 0.95D)) theoretical_rtp")
    got = by(daily.interaction_ratios(df), "theoretical_rtp")
    assert got[0.0]["hold_vs_expected"] == 0.0
    assert got[1.0]["hold_vs_expected"] is None
    assert got[0.95]["hold_vs_expected"] == pytest.approx(1.0)


def test_game_sums_equal_platform_sums(spark):
    tx = adapters.bets(spark, SF).where("game_id <> 'G005'")
    games = daily.daily_game_aggregate(tx, adapters.games(spark)).groupBy("date").agg(
        *[F.sum(c).alias(c) for c in ("total_bets", "total_wagered", "total_won", "gross_gaming_revenue")]
    )
    platform = by(daily.platform_summary(tx), "date")
    for date, row in by(games, "date").items():
        for c in ("total_bets", "total_wagered", "total_won", "gross_gaming_revenue"):
            assert row[c] == pytest.approx(platform[date][c])


def test_cumulative_base_never_falls(spark):
    got = daily.platform_growth(adapters.ledger(spark, SF)).orderBy("date").collect()
    totals = [r.cumulative_player_base for r in got]
    assert totals == sorted(totals) and totals[-1] == sum(r.new_players_today for r in got)


def test_kpis_fall_back_without_optional_columns(spark):
    df = spark.createDataFrame(
        [("2024-01-01", 4.0, 40.0, 2, 10.0)],
        "date string, daily_ggr double, total_wagered double, total_bets int, hold_percentage double",
    ).withColumn("date", F.to_date("date"))
    row = daily.kpi_strip(df).first()
    assert (row.total_ggr, row.avg_daily_users, row.wagered_per_day) == (4.0, 100.0, 40.0)


def test_all_windows_of_the_feature_table_share_one_shuffle(spark):
    out = daily.daily_features(adapters.bets(spark, SF), adapters.games(spark))
    physical = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" in physical
    assert physical.count("Exchange hashpartitioning(game_id") <= 2  # the other one joins games
