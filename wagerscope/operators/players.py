"""One row per player: behaviour features, summaries and risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerscope.functions import calendar, scans
from wagerscope.functions.metrics import mean, money_sum, ratio
from wagerscope.operators import rows


def _most_frequent(col: str, slots: range) -> Column:
    """Most frequent of a few known values, the smallest on a tie, as one aggregate."""
    counts = F.array(*[F.count_if(F.col(col) == v) for v in slots])
    at = F.array_position(counts, F.array_max(counts)).cast("int") - 1
    # Without any non-null value every count is 0 and there is no mode.
    return F.when(F.count(col) > 0, F.lit(slots.start) + at)


def _bet_measures(accuracy: int) -> list[Column]:
    bet, net = F.col("bet_amount"), F.col("net_result")
    as_num = bet.cast("double")
    return [
        F.count("*").alias("total_bets"),
        money_sum("bet_amount").alias("total_wagered"),
        money_sum("win_amount").alias("total_winnings"),
        money_sum("net_result").alias("total_net_result"),
        F.abs(money_sum("net_result")).alias("total_net_loss"),
        mean("bet_amount").alias("avg_bet_amount"),
        F.stddev_pop(as_num).alias("stddev_bet_amount"),
        F.percentile_approx(as_num, 0.5, accuracy).alias("median_bet_amount"),
        F.min(as_num).alias("min_bet_amount"),
        F.max(as_num).alias("max_bet_amount"),
        ratio(F.stddev_pop(as_num), mean("bet_amount"), 0).alias("bet_cv"),
        F.min("timestamp").alias("first_bet_date"),
        F.max("timestamp").alias("last_bet_date"),
        F.datediff(F.max("date"), F.min("date")).alias("days_active_span"),
        F.count_if(net > 0).alias("winning_bets"),
        F.count_if(net < 0).alias("losing_bets"),
        F.count_if(net == 0).alias("neutral_bets"),
        ratio(F.count_if(net > 0), F.count("*"), 0).alias("win_rate"),
        F.max("consecutive_losses").alias("max_consecutive_losses"),
        F.max("consecutive_wins").alias("max_consecutive_wins"),
        mean("consecutive_losses").alias("avg_consecutive_losses"),
        ratio(F.count_if(F.col("is_weekend") == 1), F.count("*")).alias("weekend_play_pct"),
        ratio(F.count_if(F.col("is_peak_hour") == 1), F.count("*")).alias("peak_hour_play_pct"),
        ratio(F.count_if(F.col("is_payday") == 1), F.count("*")).alias("payday_play_pct"),
    ]


def _mode_measures() -> list[Column]:
    # 0-7 covers weekdays numbered from 0 and from 1.
    return [
        _most_frequent("day_of_week", range(0, 8)).alias("most_common_day"),
        _most_frequent("hour", range(0, 24)).alias("most_common_hour"),
    ]


def _distinct_measures(tx: DataFrame, since_7: Column, since_30: Column) -> DataFrame:
    """Distinct sessions, days and games per player from one row per combination."""
    cells = tx.select("player_id", "session_id", "date", "game_id").distinct()

    def days(since: Column) -> Column:
        return F.count_distinct(F.when(F.col("date") >= since, F.col("date")))

    return (
        cells.withColumns({"_since_7": since_7, "_since_30": since_30})
        .groupBy("player_id")
        .agg(
            F.count_distinct("session_id").alias("total_sessions"),
            F.count_distinct("date").alias("active_days"),
            F.count_distinct("game_id").alias("games_played"),
            days(F.col("_since_7")).alias("active_days_last_7d"),
            days(F.col("_since_30")).alias("active_days_last_30d"),
        )
    )


def player_base(tx: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """volume, money, bet spread, win rate, streaks and play-time shares."""
    never = F.lit(None).cast("date")
    counts = _distinct_measures(tx, never, never).select(
        "player_id", "total_sessions", "active_days", "games_played"
    )
    return tx.groupBy("player_id").agg(*_bet_measures(accuracy)).join(counts, "player_id")


def most_common_times(tx: DataFrame) -> DataFrame:
    """the weekday and hour a player bets most, the smaller one on a tie."""
    return tx.groupBy("player_id").agg(*_mode_measures())


def distinct_rows(df: DataFrame, *cols: str) -> DataFrame:
    """F3."""
    return (df.select(*cols) if cols else df).distinct()


def session_rollup(tx: DataFrame) -> DataFrame:
    """length, bets, result and balances of each session."""
    balance = F.col("session_balance").cast("double")
    return tx.groupBy("player_id", "session_id").agg(
        (
            (F.unix_timestamp(F.max("timestamp")) - F.unix_timestamp(F.min("timestamp"))) / 60.0
        ).alias("session_duration_minutes"),
        F.count("*").alias("bets_per_session"),
        F.sum("net_result").alias("session_net_result"),
        F.min(balance).alias("min_session_balance"),
        F.max(balance).alias("max_session_balance"),
        F.max_by(balance, F.struct("timestamp", "transaction_id")).alias("last_session_balance"),
    )


def session_features(tx: DataFrame, balance_mode: str = "low_and_result") -> DataFrame:
    """a player's average session and its extremes.

    ``balance_mode`` picks what worst and best mean: ``low_and_result`` (lowest
    running balance, best session result), ``peak`` (extremes of each session's
    highest balance) or ``closing`` (extremes of closing balances).
    """
    worst, best = {
        "low_and_result": ("min_session_balance", "session_net_result"),
        "peak": ("max_session_balance", "max_session_balance"),
        "closing": ("last_session_balance", "last_session_balance"),
    }[balance_mode]
    return session_rollup(tx).groupBy("player_id").agg(
        F.avg("session_duration_minutes").alias("avg_session_duration"),
        F.stddev_pop("session_duration_minutes").alias("stddev_session_duration"),
        mean("bets_per_session").alias("avg_bets_per_session"),
        mean("session_net_result").alias("avg_session_net_result"),
        F.min(F.col(worst).cast("double")).alias("worst_session_balance"),
        F.max(F.col(best).cast("double")).alias("best_session_result"),
    )


def recency_features(tx: DataFrame, as_of=None) -> DataFrame:
    """days since the last bet and recent activity, against the end of the data."""
    end = calendar.anchor(tx, as_of)
    start = tx.agg(F.min("date")).scalar()
    days = (
        tx.select("player_id", "date")
        .distinct()
        .withColumns({"_end": end, "_period": F.datediff(end, start) + 1})
    )
    return days.groupBy("player_id").agg(
        F.datediff(F.max("_end"), F.max("date")).alias("days_since_last_bet"),
        F.count_if(F.col("date") >= F.date_sub("_end", 7)).alias("active_days_last_7d"),
        F.count_if(F.col("date") >= F.date_sub("_end", 30)).alias("active_days_last_30d"),
        ratio(F.count("*"), F.max("_period")).alias("pct_days_active_in_period"),
    )


def bet_escalation(
    tx: DataFrame, chase_factor: float = 1.2, slice_seconds: int = scans.SLICE_SECONDS
) -> DataFrame:
    """how bets grow after a loss in the same session.

    The average runs over all bets; bets that do not grow after a loss count 0.
    """
    moves = tx.select(
        "player_id",
        "session_id",
        "timestamp",
        "transaction_id",
        F.col("bet_amount").cast("double").alias("bet"),
        F.col("net_result").cast("double").alias("net"),
    )
    seq = scans.ordered_state(
        moves, previous={"bet": "prev_bet", "net": "prev_net"}, slice_seconds=slice_seconds
    )
    bet, prev, after_loss = F.col("bet"), F.col("prev_bet"), F.col("prev_net") < 0
    grown = ratio(bet - prev, prev)
    return seq.groupBy("player_id").agg(
        F.avg(F.when(after_loss & (bet > prev), grown).otherwise(0.0)).alias(
            "avg_bet_increase_after_loss"
        ),
        F.count_if(after_loss & (bet > prev * chase_factor)).alias("chasing_incidents"),
    )


def risk_score() -> Column:
    """0-8 points from bet size, losses, streaks, chasing and bet spread."""

    def points(condition: Column, n: int) -> Column:
        return F.when(condition, n).otherwise(0)

    # Limits and weights of the preliminary score.
    return (
        points(F.col("avg_bet_amount") > 100, 2)
        + points(F.col("total_net_loss") > 10000, 2)
        + points(F.col("max_consecutive_losses") > 5, 1)
        + points(F.col("chasing_incidents") > 10, 2)
        + points(F.col("bet_cv") > 1.0, 1)
    )


def training_features(
    tx: DataFrame,
    as_of=None,
    min_bets: int = 10,
    min_days: int = 2,
    accuracy: int = 10_000,
    ordered: bool = False,
) -> DataFrame:
    """F8: one row per active player with all behaviour features and the risk score.

    Every part is aggregated to one row per player before it is joined, and all
    joins use the same key.  ``ordered`` adds the global sort by total wagered.
    """
    end = calendar.anchor(tx, as_of)
    start = tx.agg(F.min("date")).scalar()
    core = tx.groupBy("player_id").agg(
        *_bet_measures(accuracy), *_mode_measures(), F.max("date").alias("_last_day")
    )
    counts = _distinct_measures(tx, F.date_sub(end, 7), F.date_sub(end, 30))
    sessions = session_features(tx).drop("avg_bets_per_session", "best_session_result")
    joined = rows.minimum_activity(core.join(counts, "player_id", "left"), min_bets, min_days)
    joined = joined.join(sessions, "player_id", "left").join(bet_escalation(tx), "player_id", "left")
    out = joined.select(
        "player_id",
        "total_wagered",
        "total_net_loss",
        "avg_bet_amount",
        "median_bet_amount",
        "total_sessions",
        "active_days",
        ratio("total_sessions", "active_days", 0).alias("sessions_per_day"),
        ratio("total_bets", "total_sessions", 0).alias("bets_per_session"),
        ratio("active_days", "days_active_span", 0).alias("activity_ratio"),
        "stddev_bet_amount",
        F.col("bet_cv").alias("bet_volatility_coefficient"),
        "max_bet_amount",
        "min_bet_amount",
        "win_rate",
        "winning_bets",
        "losing_bets",
        "max_consecutive_losses",
        "avg_consecutive_losses",
        "avg_bet_increase_after_loss",
        "chasing_incidents",
        "avg_session_duration",
        "stddev_session_duration",
        "avg_session_net_result",
        "worst_session_balance",
        "weekend_play_pct",
        "peak_hour_play_pct",
        "payday_play_pct",
        "most_common_day",
        "most_common_hour",
        F.datediff(end, F.col("_last_day")).alias("days_since_last_bet"),
        "active_days_last_7d",
        "active_days_last_30d",
        ratio(F.col("active_days"), F.datediff(end, start) + 1).alias("pct_days_active_in_period"),
        "games_played",
        "first_bet_date",
        "last_bet_date",
        "days_active_span",
        risk_score().alias("preliminary_risk_score"),
    )
    return out.orderBy(F.desc("total_wagered")) if ordered else out


def summary_features(tx: DataFrame) -> DataFrame:
    """F1, F5-F7 in the variant with sample spreads, exact medians and inclusive spans.

    NULLs (spread of a single bet) become 0.  Session extremes are closing balances.
    """
    bet, net = F.col("bet_amount").cast("double"), F.col("net_result")
    seconds = F.unix_timestamp(F.max("timestamp")) - F.unix_timestamp(F.min("timestamp"))
    core = tx.groupBy("player_id").agg(
        F.count("*").alias("total_bets"),
        money_sum("bet_amount").alias("total_wagered"),
        mean("bet_amount").alias("avg_bet_amount"),
        F.stddev_samp(bet).alias("stddev_bet_amount"),
        F.min(bet).alias("min_bet_amount"),
        F.max(bet).alias("max_bet_amount"),
        money_sum("win_amount").alias("total_winnings"),
        money_sum("net_result").alias("total_net_result"),
        F.abs(money_sum("net_result")).alias("total_net_loss"),
        F.max("consecutive_losses").alias("max_consecutive_losses"),
        F.max("consecutive_wins").alias("max_consecutive_wins"),
        ratio(F.count_if(F.col("is_weekend") == 1), F.count("*")).alias("weekend_play_pct"),
        ratio(F.count_if(F.col("is_peak_hour") == 1), F.count("*")).alias("peak_hour_play_pct"),
        ratio(F.count_if(F.col("is_payday") == 1), F.count("*")).alias("payday_play_pct"),
        ratio(F.stddev_samp(bet), mean("bet_amount")).alias("bet_cv"),
        (F.floor(seconds / 86_400) + 1).cast("int").alias("days_active_span"),
        F.count_if(net > 0).alias("winning_bets"),
        F.count_if(net < 0).alias("losing_bets"),
        F.count_if(net == 0).alias("neutral_bets"),
        ratio(F.count_if(net > 0), F.count("*")).alias("win_rate"),
        F.max("date").alias("_last_day"),
    )
    medians = scans.exact_quantiles(tx, "bet_amount", {"median_bet_amount": 0.5}, by=["player_id"])
    never = F.lit(None).cast("date")
    counts = _distinct_measures(tx, never, never).drop(
        "active_days_last_7d", "active_days_last_30d"
    )
    sessions = session_rollup(tx).groupBy("player_id").agg(
        F.avg("session_duration_minutes").alias("avg_session_duration"),
        F.stddev_samp("session_duration_minutes").alias("stddev_session_duration"),
        mean("bets_per_session").alias("avg_bets_per_session"),
        mean("session_net_result").alias("avg_session_net_result"),
        F.min("last_session_balance").alias("worst_session_balance"),
        F.max("last_session_balance").alias("best_session_balance"),
    )
    chasing = bet_escalation(tx).select("player_id", "chasing_incidents")
    out = core
    for part in (medians, counts, sessions, chasing):
        out = out.join(part, "player_id", "left")
    out = out.withColumns(
        {
            "sessions_per_day": ratio("total_sessions", "active_days"),
            "bets_per_session": ratio("total_bets", "total_sessions"),
            "activity_ratio": ratio("active_days", "days_active_span"),
            "days_since_last_bet": F.datediff(calendar.latest(tx), F.col("_last_day")),
        }
    ).drop("_last_day")
    keys = {"player_id"}
    return rows.fill_numeric(out, 0, [c for c in out.columns if c not in keys])


def player_summary(tx: DataFrame, players: DataFrame | None = None) -> DataFrame:
    """lifetime totals per player, with the player table's columns if given.

    ``days_active`` counts whole days between first and last bet, plus one.
    """
    sessions = (
        tx.select("player_id", "session_id")
        .distinct()
        .groupBy("player_id")
        .agg(F.count("session_id").alias("total_sessions"))
    )
    seconds = F.unix_timestamp(F.max("timestamp")) - F.unix_timestamp(F.min("timestamp"))
    totals = tx.groupBy("player_id").agg(
        F.count("transaction_id").alias("total_bets"),
        money_sum("bet_amount").alias("total_wagered"),
        money_sum("win_amount").alias("total_won"),
        mean("bet_amount").alias("avg_bet"),
        F.stddev_samp(F.col("bet_amount").cast("double")).alias("bet_volatility"),
        money_sum("net_result").alias("net_loss"),
        F.min("timestamp").alias("first_bet"),
        F.max("timestamp").alias("last_bet"),
        (F.floor(seconds / 86_400) + 1).cast("int").alias("days_active"),
    )
    out = totals.join(sessions, "player_id")
    if players is not None:
        out = out.join(players, "player_id", "left")
    return out.withColumn("lifetime_value", 0 - F.col("net_loss")).withColumn(
        "avg_daily_value", ratio("lifetime_value", "days_active")
    )


def with_churn_flag(
    summary: DataFrame, tx: DataFrame, churn_days: int = 60, as_of=None
) -> DataFrame:
    """a player is churned after ``churn_days`` without a bet; the date is the last bet's."""
    idle = F.datediff(calendar.anchor(tx, as_of), F.to_date("last_bet"))
    gone = idle > churn_days
    return summary.withColumns(
        {
            "is_churned": gone,
            "churn_date": F.when(gone, F.to_date("last_bet")),
        }
    )
