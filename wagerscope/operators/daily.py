"""Daily game and platform tables and their time-series features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagerscope.functions import scans
from wagerscope.functions.metrics import mean, ratio
from wagerscope.operators import rows

GAME_ATTRIBUTES = ("game_type", "theoretical_rtp", "volatility", "visual_engagement")


def first_appearance(tx: DataFrame) -> DataFrame:
    """Each player's first day."""
    return tx.groupBy("player_id").agg(F.min(F.to_date("timestamp")).alias("first_play_date"))


def platform_growth(tx: DataFrame) -> DataFrame:
    """New players per day and their running total."""
    # One row per calendar day by now, so an unpartitioned window is small.
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        first_appearance(tx)
        .groupBy(F.col("first_play_date").alias("date"))
        .agg(F.count("player_id").alias("new_players_today"))
        .withColumn("cumulative_player_base", F.sum("new_players_today").over(so_far))
    )


def _day_measures(tx: DataFrame, keys: list[str]) -> DataFrame:
    """Sums and distinct counts per key, from rows first folded to one per session.

    The fold runs map-side, and a busy day or game is spread over its players
    and sessions.
    """
    folded = (
        tx.withColumn("date", F.to_date("timestamp"))
        .groupBy(*keys, "player_id", "session_id")
        .agg(
            F.count("transaction_id").alias("bets"),
            F.sum("bet_amount").alias("wagered"),
            F.sum("win_amount").alias("won"),
            F.sum("net_result").alias("net"),
        )
    )
    counted = {"players": "player_id", "sessions": "session_id"}
    totals = scans.sums_and_distinct(folded, keys, ["bets", "wagered", "won", "net"], counted)
    return totals.select(
        *keys,
        "players",
        "sessions",
        "bets",
        *[F.col(c).cast("double").alias(c) for c in ("wagered", "won", "net")],
    )


def daily_game_aggregate(
    tx: DataFrame, games: DataFrame, carry_forward: bool = False
) -> DataFrame:
    """One row per day and game with 14 measures and 4 game attributes.

    ``cumulative_player_base`` is 0 on a day without new players, unless
    ``carry_forward`` keeps the last known total.
    """
    measures = _day_measures(tx, ["date", "game_id"])
    growth = platform_growth(tx).select("date", "cumulative_player_base")
    if carry_forward:
        so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        days = tx.select(F.to_date("timestamp").alias("date")).distinct()
        growth = days.join(growth, "date", "left").select(
            "date",
            F.last("cumulative_player_base", ignorenulls=True)
            .over(so_far)
            .alias("cumulative_player_base"),
        )
    attributes = games.select(
        "game_id",
        F.col("type").alias("game_type"),
        F.col("rtp").alias("theoretical_rtp"),
        "volatility",
        "visual_engagement",
    )
    joined = measures.join(attributes, "game_id").join(growth, "date", "left")
    return joined.select(
        "date",
        "game_id",
        F.coalesce("cumulative_player_base", F.lit(0)).alias("cumulative_player_base"),
        F.col("players").alias("daily_active_users"),
        F.col("wagered").alias("gross_daily_revenue"),
        F.col("won").alias("daily_payout"),
        (0 - F.col("net")).alias("daily_ggr"),
        F.col("bets").alias("total_bets"),
        F.col("players").alias("active_players"),
        F.col("wagered").alias("total_wagered"),
        F.col("won").alias("total_won"),
        F.col("net").alias("gross_gaming_revenue"),
        F.col("sessions").alias("total_sessions"),
        (ratio(0 - F.col("net"), "wagered", 0) * 100).alias("hold_percentage"),
        ratio("wagered", "bets", 0).alias("avg_bet_size"),
        ratio("bets", "players", 0).alias("bets_per_player"),
        *GAME_ATTRIBUTES,
    )


# Daily tables hold one row per day and game, so windows by game stay small
# whatever the size of the bet log.
def _by_game() -> Window:
    return Window.partitionBy("game_id").orderBy("date")


def _moving(days: int) -> Window:
    return _by_game().rowsBetween(1 - days, Window.currentRow)


def _guard(value: Column, days: int, min_periods: int) -> Column:
    """NULL until the window holds ``min_periods`` rows."""
    if min_periods <= 1:
        return value
    return F.when(F.count("*").over(_moving(days)) >= min_periods, value)


def _moving_mean(col: str, days: int) -> Column:
    return F.avg(F.col(col).cast("double")).over(_moving(days))


def lag_features(daily: DataFrame) -> DataFrame:
    """T4: values 1, 7 and 30 rows before (rows, not days)."""
    lags = {
        "ggr_lag1": ("daily_ggr", 1),
        "ggr_lag7": ("daily_ggr", 7),
        "ggr_lag30": ("daily_ggr", 30),
        "revenue_lag1": ("total_wagered", 1),
        "revenue_lag7": ("total_wagered", 7),
        "revenue_lag30": ("total_wagered", 30),
        "dau_lag1": ("daily_active_users", 1),
        "dau_lag7": ("daily_active_users", 7),
        "bets_lag7": ("total_bets", 7),
        "player_base_lag7": ("cumulative_player_base", 7),
    }
    return daily.withColumns(
        {name: F.lag(col, n).over(_by_game()) for name, (col, n) in lags.items()}
    )


def moving_averages(daily: DataFrame, min_periods: int = 1) -> DataFrame:
    """T5: 7 and 30 row means; partial windows count unless ``min_periods`` is raised."""
    means = {
        "ggr_ma7": ("daily_ggr", 7),
        "ggr_ma30": ("daily_ggr", 30),
        "revenue_ma7": ("total_wagered", 7),
        "revenue_ma30": ("total_wagered", 30),
        "dau_ma7": ("daily_active_users", 7),
        "bets_ma7": ("total_bets", 7),
    }
    return daily.withColumns(
        {
            name: _guard(_moving_mean(col, n), n, min(n, min_periods))
            for name, (col, n) in means.items()
        }
    )


def moving_deviations(daily: DataFrame, min_periods: int = 1) -> DataFrame:
    """Sample standard deviations; NULL over a single row."""
    spreads = {
        "ggr_std7": ("daily_ggr", 7),
        "ggr_std30": ("daily_ggr", 30),
        "revenue_std7": ("total_wagered", 7),
    }
    return daily.withColumns(
        {
            name: _guard(F.stddev_samp(col).over(_moving(n)), n, min(n, min_periods))
            for name, (col, n) in spreads.items()
        }
    )


def moving_sums(daily: DataFrame, min_periods: int = 1) -> DataFrame:
    """T7."""
    return daily.withColumns(
        {
            "ggr_sum7": _guard(F.sum("daily_ggr").over(_moving(7)), 7, min_periods),
            "revenue_sum7": _guard(F.sum("total_wagered").over(_moving(7)), 7, min_periods),
        }
    )


def moving_range(daily: DataFrame, min_periods: int = 1) -> DataFrame:
    """Smallest, largest and their distance over 7 rows."""
    low = _guard(F.min("daily_ggr").over(_moving(7)), 7, min_periods)
    high = _guard(F.max("daily_ggr").over(_moving(7)), 7, min_periods)
    out = daily.withColumns({"ggr_min7": low, "ggr_max7": high})
    return out.withColumn(
        "ggr_range7", F.coalesce(F.col("ggr_max7") - F.col("ggr_min7"), F.lit(0.0))
    )


def growth_rates(lagged: DataFrame) -> DataFrame:
    """Change against the lag; 0 where the lag is missing or 0."""

    def change(now: str, then: str, base: Column) -> Column:
        return ratio(F.col(now) - F.col(then), base, 0)

    return lagged.withColumns(
        {
            "ggr_growth_7d": change("daily_ggr", "ggr_lag7", F.abs("ggr_lag7")),
            "ggr_growth_30d": change("daily_ggr", "ggr_lag30", F.abs("ggr_lag30")),
            "revenue_growth_7d": change("total_wagered", "revenue_lag7", F.col("revenue_lag7")),
            "dau_growth_7d": change("daily_active_users", "dau_lag7", F.col("dau_lag7")),
            "player_growth_7d": change(
                "cumulative_player_base", "player_base_lag7", F.col("player_base_lag7")
            ),
        }
    )


def interaction_ratios(daily: DataFrame) -> DataFrame:
    """Per-player and per-session ratios; hold against the game's expectation.

    ``hold_vs_expected`` is 0 for rtp 0 and NULL for rtp 1, where no hold is expected.
    """
    expected = 100 * (1 - F.col("theoretical_rtp"))
    return daily.withColumns(
        {
            "ggr_per_player": ratio("daily_ggr", "daily_active_users", 0),
            "revenue_per_player": ratio("total_wagered", "daily_active_users", 0),
            "bets_per_session": ratio("total_bets", "total_sessions", 0),
            "hold_vs_expected": F.when(F.col("theoretical_rtp") == 0, 0.0).otherwise(
                ratio("hold_percentage", expected)
            ),
        }
    )


def volatility_ratio(averaged: DataFrame) -> DataFrame:
    """The day's revenue against its 7-row mean."""
    return averaged.withColumn("ggr_vs_ma7_ratio", ratio("daily_ggr", "ggr_ma7", 0))


def daily_features(tx: DataFrame, games: DataFrame, carry_forward: bool = False) -> DataFrame:
    """T3-T11 and P2 in one table; all windows share one shuffle and sort."""
    out = rows.temporal_features(daily_game_aggregate(tx, games, carry_forward))
    for step in (
        lag_features,
        moving_averages,
        moving_deviations,
        moving_sums,
        moving_range,
        growth_rates,
        interaction_ratios,
        volatility_ratio,
    ):
        out = step(out)
    return out.orderBy("date", "game_id")


def platform_summary(tx: DataFrame) -> DataFrame:
    """One row per day over all games, listed or not."""
    return _day_measures(tx, ["date"]).select(
        "date",
        F.col("bets").alias("total_bets"),
        F.col("players").alias("active_players"),
        F.col("wagered").alias("total_wagered"),
        F.col("won").alias("total_won"),
        F.col("net").alias("gross_gaming_revenue"),
        F.col("sessions").alias("total_sessions"),
        (ratio(0 - F.col("net"), "wagered") * 100).alias("hold_percentage"),
        ratio("wagered", "bets").alias("avg_bet_size"),
        ratio("bets", "players").alias("bets_per_player"),
    )


def kpi_strip(daily: DataFrame, start=None, end=None) -> DataFrame:
    """Headline figures of a daily table over a date range.

    Falls back to ``daily_ggr`` if the table has no ``gross_gaming_revenue``,
    and to 100 daily users if it has no ``daily_active_users`` (S13).
    """
    if start is not None or end is not None:
        daily = rows.date_range(daily, start or "0001-01-01", end or "9999-12-31")
    if "gross_gaming_revenue" in daily.columns:
        revenue = 0 - F.sum("gross_gaming_revenue")
    else:
        revenue = F.sum("daily_ggr")
    if "daily_active_users" in daily.columns:
        users = mean("daily_active_users")
    else:
        users = F.lit(100.0)
    totals = daily.agg(
        revenue.cast("double").alias("total_ggr"),
        F.sum("total_wagered").alias("total_wagered"),
        F.sum("total_bets").alias("total_bets"),
        F.avg("hold_percentage").alias("avg_hold"),
        F.count_distinct("date").alias("unique_days"),
        users.alias("avg_daily_users"),
    )
    days = F.greatest("unique_days", F.lit(1))
    return totals.withColumns(
        {
            "wagered_per_day": ratio("total_wagered", days),
            "bets_per_day": ratio("total_bets", days),
        }
    )


def daily_ggr_trend(daily: DataFrame, window_rows: int = 7) -> DataFrame:
    """Revenue per day with its mean over full windows only."""
    trailing = Window.orderBy("date").rowsBetween(1 - window_rows, Window.currentRow)
    by_day = daily.groupBy("date").agg(
        F.sum(0 - F.col("gross_gaming_revenue")).alias("ggr"),
        F.sum("total_wagered").alias("total_wagered"),
        F.sum("total_bets").alias("total_bets"),
        F.sum("daily_active_users").alias("daily_active_users"),
    )
    full = F.count("*").over(trailing) >= window_rows
    return by_day.withColumn("ma7", F.when(full, F.avg("ggr").over(trailing)))


def wagering_by_game(daily: DataFrame, games: DataFrame) -> DataFrame:
    """Each game's total and its share of all."""
    totals = daily.groupBy("game_id").agg(F.sum("total_wagered").alias("total_wagered"))
    every = Window.partitionBy()
    shared = totals.withColumn(
        "pct_of_total", ratio(F.col("total_wagered") * 100, F.sum("total_wagered").over(every))
    )
    return rows.with_game_names(shared, games)


def hold_by_game_and_day(daily: DataFrame) -> DataFrame:
    """T16."""
    return daily.groupBy("game_id", "date").agg(F.avg("hold_percentage").alias("hold_percentage"))


def game_comparison(daily: DataFrame, games: DataFrame) -> DataFrame:
    """Per-game totals and means; ``relative_size`` is against the largest game."""
    stats = daily.groupBy("game_id").agg(
        F.sum("total_wagered").alias("total_wagered"),
        F.sum("total_bets").alias("total_bets"),
        F.avg("hold_percentage").alias("hold_percentage"),
        F.avg("avg_bet_size").alias("avg_bet_size"),
        mean("daily_active_users").alias("daily_active_users"),
    )
    largest = F.max("total_wagered").over(Window.partitionBy())
    return rows.with_game_names(
        stats.withColumn("relative_size", ratio("total_wagered", largest)), games
    )


def type_comparison(daily: DataFrame) -> DataFrame:
    """Slots against tables."""
    return daily.groupBy("game_type").agg(
        F.sum("total_wagered").alias("total_wagered"),
        F.sum("total_bets").alias("total_bets"),
        F.avg("hold_percentage").alias("hold_percentage"),
    )
