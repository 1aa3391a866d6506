"""Segment, persona and distribution dashboards.

Bets are folded per player before segments are joined, so the join never moves
single bets and a busy player weighs no more than the days they played.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagerscope.functions import calendar, scans
from wagerscope.functions.metrics import (
    as_double,
    ggr,
    mean,
    money_sum,
    ratio,
    sample_skewness,
)
from wagerscope.operators import rows
from wagerscope.plans.activity import player_days


def _segment_of(segments: DataFrame) -> DataFrame:
    return segments.select("player_id", "player_segment")


def daily_by_segment(
    tx: DataFrame,
    segments: DataFrame,
    lookback_days: int | None = 90,
    as_of=None,
    ggr_level: str = "player_day",
) -> DataFrame:
    """G1: daily metrics by segment.

    ``player_day``: revenue is what losing player-days lost.
    ``segment_day``: revenue is the segment's result of the day, 0 if players won.
    """
    recent = calendar.look_back(tx, lookback_days, as_of)
    cells = player_days(recent, "session_id")
    if ggr_level == "segment_day":
        return _daily_segment_totals(cells, segments, ["date"])
    per_player = cells.groupBy("date", "player_id").agg(
        F.sum("bets").alias("bets"),
        F.sum("wagered").alias("wagered"),
        F.sum("winnings").alias("winnings"),
        F.sum("net_result").alias("net_result"),
        F.count("session_id").alias("sessions"),
    )
    joined = per_player.join(_segment_of(segments), "player_id")
    kept = ggr("net_result", "losses").cast("double")
    return (
        joined.groupBy("date", "player_segment")
        .agg(
            F.count_distinct("player_id").alias("active_players"),
            F.sum("bets").alias("total_bets"),
            money_sum("wagered").alias("total_wagered"),
            money_sum("winnings").alias("total_winnings"),
            money_sum("net_result").alias("total_net_result"),
            kept.alias("total_ggr"),
            F.sum("sessions").alias("total_sessions"),
            mean("bets").alias("avg_bets_per_player"),
            mean("wagered").alias("avg_wagered_per_player"),
            mean("net_result").alias("avg_net_result_per_player"),
            (ratio(kept, money_sum("wagered"), 0) * 100).alias("hold_percentage"),
        )
        .orderBy("date", "player_segment")
    )


def _daily_segment_totals(cells: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    joined = cells.join(_segment_of(segments), "player_id")
    kept = ggr("net_result", "house_or_zero").cast("double")
    out = joined.groupBy(*keys, "player_segment").agg(
        F.count_distinct("player_id").alias("active_players"),
        F.sum("bets").alias("total_bets"),
        money_sum("wagered").alias("total_wagered"),
        money_sum("winnings").alias("total_winnings"),
        money_sum("net_result").alias("total_net_result"),
        F.count_distinct("session_id").alias("total_sessions"),
        kept.alias("total_ggr"),
        (ratio(kept, money_sum("wagered"), 0) * 100).alias("hold_percentage"),
    )
    if keys == ["date"]:
        out = out.withColumn("avg_wagered_per_player", ratio("total_wagered", "active_players"))
    return out.orderBy(*keys, "player_segment")


def weekly_by_segment(
    tx: DataFrame,
    segments: DataFrame,
    lookback_days: int | None = 180,
    as_of=None,
    ggr_level: str = "player_week",
) -> DataFrame:
    """Weekly metrics by segment with active days and revenue per user."""
    recent = calendar.look_back(tx, lookback_days, as_of)
    cells = player_days(recent, "session_id").withColumn("week_start", calendar.week_of("date"))
    if ggr_level == "segment_week":
        return _daily_segment_totals(cells, segments, ["week_start"])
    per_player = cells.groupBy("week_start", "player_id").agg(
        F.sum("bets").alias("bets"),
        F.sum("wagered").alias("wagered"),
        F.sum("winnings").alias("winnings"),
        F.sum("net_result").alias("net_result"),
        F.count_distinct("session_id").alias("sessions"),
        F.count_distinct("date").alias("active_days"),
    )
    joined = per_player.join(_segment_of(segments), "player_id")
    kept = ggr("net_result", "losses").cast("double")
    return (
        joined.groupBy("week_start", "player_segment")
        .agg(
            F.count_distinct("player_id").alias("active_players"),
            F.sum("bets").alias("total_bets"),
            money_sum("wagered").alias("total_wagered"),
            money_sum("winnings").alias("total_winnings"),
            money_sum("net_result").alias("total_net_result"),
            kept.alias("total_ggr"),
            F.sum("sessions").alias("total_sessions"),
            F.sum("active_days").alias("total_active_days"),
            mean("bets").alias("avg_bets_per_player"),
            mean("wagered").alias("avg_wagered_per_player"),
            mean("sessions").alias("avg_sessions_per_player"),
            mean("active_days").alias("avg_active_days_per_player"),
            (ratio(kept, money_sum("wagered"), 0) * 100).alias("hold_percentage"),
            ratio(F.sum("wagered"), F.count_distinct("player_id"), 0).alias(
                "avg_revenue_per_user"
            ),
        )
        .orderBy("week_start", "player_segment")
    )


def segment_snapshot(
    tx: DataFrame, segments: DataFrame, days: int = 30, as_of=None
) -> DataFrame:
    """Players, wagers and revenue of the last days, idle players included."""
    recent = (
        calendar.look_back(tx, days, as_of)
        .groupBy("player_id")
        .agg(
            F.sum("bet_amount").alias("wagered"),
            ggr("net_result", "losses").alias("lost"),
        )
    )
    per_segment = (
        _segment_of(segments)
        .join(recent, "player_id", "left")
        .groupBy("player_segment")
        .agg(
            F.count_distinct("player_id").alias("player_count"),
            F.coalesce(money_sum("wagered"), F.lit(0.0)).alias("wagered_30d"),
            F.coalesce(money_sum("lost"), F.lit(0.0)).alias("ggr_30d"),
        )
    )
    total = F.sum("ggr_30d").over(Window.partitionBy())
    return per_segment.withColumn(
        "pct_of_total_ggr", ratio(F.col("ggr_30d") * 100.0, total)
    ).orderBy(F.desc("ggr_30d"))


def risk_indicators(
    tx: DataFrame,
    segments: DataFrame,
    days: int = 30,
    streak: int = 5,
    session_loss: float = 1000,
    as_of=None,
) -> DataFrame:
    """Players with long losing streaks or deep session losses, per segment."""
    recent = (
        calendar.look_back(tx, days, as_of)
        .groupBy("player_id")
        .agg(
            F.max(F.col("consecutive_losses") >= streak).alias("long_streak"),
            F.max(F.col("session_balance") < -session_loss).alias("deep_loss"),
            F.sum("consecutive_losses").alias("losses_sum"),
            F.count("consecutive_losses").alias("losses_n"),
        )
    )
    joined = _segment_of(segments).join(recent, "player_id", "left")

    def players(flag: Column) -> Column:
        return F.count_distinct(F.when(flag, F.col("player_id")))

    risky = F.coalesce("long_streak", F.lit(False)) | F.coalesce("deep_loss", F.lit(False))
    return (
        joined.groupBy("player_segment")
        .agg(
            F.count_distinct("player_id").alias("total_players"),
            players(F.col("long_streak")).alias("players_with_long_losing_streaks"),
            players(F.col("deep_loss")).alias("players_with_large_session_losses"),
            ratio(F.sum("losses_sum"), F.sum("losses_n")).alias("avg_consecutive_losses"),
            ratio(players(risky) * 100.0, F.count_distinct("player_id")).alias(
                "pct_high_risk_players"
            ),
        )
        .orderBy(F.desc("pct_high_risk_players"))
    )


def game_preference(
    tx: DataFrame, segments: DataFrame, days: int = 30, as_of=None
) -> DataFrame:
    """What each segment plays, and the share of its bets per game."""
    per_player = (
        calendar.look_back(tx, days, as_of)
        .groupBy("player_id", "game_id")
        .agg(
            F.count("*").alias("bets"),
            F.sum("bet_amount").alias("wagered"),
            ggr("net_result", "losses").alias("lost"),
        )
    )
    per_game = (
        per_player.join(_segment_of(segments), "player_id")
        .groupBy("player_segment", "game_id")
        .agg(
            F.count_distinct("player_id").alias("unique_players"),
            F.sum("bets").alias("total_bets"),
            money_sum("wagered").alias("total_wagered"),
            money_sum("lost").alias("total_ggr"),
        )
    )
    of_segment = F.sum("total_bets").over(Window.partitionBy("player_segment"))
    return per_game.withColumn(
        "pct_of_segment_bets", ratio(F.col("total_bets") * 100.0, of_segment)
    ).orderBy("player_segment", F.desc("total_ggr"))


def total_ggr_by_segment(daily_metrics: DataFrame) -> DataFrame:
    """G6."""
    return (
        daily_metrics.groupBy("player_segment")
        .agg(F.sum("total_ggr").alias("total_ggr"))
        .orderBy(F.desc("total_ggr"))
    )


def monthly_ggr_by_persona(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """Revenue and volume per calendar month and persona, in calendar order."""
    per_player = tx.groupBy("player_id", "month").agg(
        ggr("net_result").alias("ggr"), F.count("transaction_id").alias("n")
    )
    joined = per_player.join(labels.select("player_id", "label"), "player_id")
    return (
        joined.groupBy("label", "month")
        .agg(money_sum("ggr").alias("ggr"), F.sum("n").alias("tx_volume"))
        .orderBy("month", "label")
        .select("label", calendar.month_abbreviation("month").alias("month_abbr"), "ggr", "tx_volume")
    )


def arpu_by_persona(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """Mean lifetime house win and number of bets per player."""
    per_player = tx.groupBy("player_id").agg(
        ggr("net_result").alias("house_win"), F.count("transaction_id").alias("tx_count")
    )
    joined = per_player.join(labels.select("player_id", "label"), "player_id")
    return (
        joined.groupBy("label")
        .agg(
            mean("house_win").alias("avg_house_win"), mean("tx_count").alias("avg_transactions")
        )
        .orderBy(F.desc("avg_house_win"))
    )


# The letter values of an enlarged box plot.
LETTER_VALUES = {
    "p0625": 0.0625,
    "p125": 0.125,
    "p25": 0.25,
    "p50": 0.5,
    "p75": 0.75,
    "p875": 0.875,
    "p9375": 0.9375,
}


def bet_spread_by_persona(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """Letter values of bet size per persona, over all bets."""
    stakes = tx.groupBy("player_id", "bet_amount").agg(F.count("*").alias("n"))
    joined = stakes.join(labels.select("player_id", "label"), "player_id")
    return scans.exact_quantiles(joined, "bet_amount", LETTER_VALUES, by=["label"], weight="n")


def top_players(tx: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` players who wagered most."""
    return (
        tx.groupBy("player_id")
        .agg(
            money_sum("bet_amount").alias("total_wagered"),
            mean("bet_amount").alias("avg_bet"),
            F.count("bet_amount").alias("num_bets"),
            money_sum("net_result").alias("net_result"),
            money_sum("win_amount").alias("total_won"),
        )
        .orderBy(F.desc("total_wagered"), "player_id")
        .limit(n)
    )


def bet_size_by_streak(tx: DataFrame, longest: int = 10) -> DataFrame:
    """Mean bet and frequency by losses in a row."""
    return (
        tx.where(F.col("consecutive_losses") <= longest)
        .groupBy("consecutive_losses")
        .agg(mean("bet_amount").alias("avg_bet"), F.count("transaction_id").alias("count"))
    )


def pareto_curve(tx: DataFrame) -> DataFrame:
    """Cumulative share of wagers against share of players, largest first.

    Running totals are taken over (amount, tie slot) cells.  Players with the
    same amount are told apart by a digest of their id, whose first two digits
    are the tie slot: one very common amount still spreads over 256 slots.
    """
    players = (
        tx.groupBy("player_id")
        .agg(F.sum("bet_amount").alias("wagered"))
        .withColumn("_digest", F.md5(F.col("player_id").cast("string")))
        .withColumn("_slot", F.substring("_digest", 1, 2))
    )
    cells = players.groupBy("wagered", "_slot").agg(
        F.count("*").alias("n"), F.sum("wagered").alias("amount")
    )
    before = scans.totals_before(
        cells, "wagered", ["n", "amount"], tie=["_slot"], descending=True
    )
    place = Window.partitionBy("wagered", "_slot").orderBy("_digest", "player_id")
    placed = players.withColumn("_rn", F.row_number().over(place))
    ranked = placed.join(before, ["wagered", "_slot"])
    cumulative = as_double("amount_before") + as_double(F.col("_rn") * F.col("wagered"))
    return ranked.select(
        "player_id",
        F.col("wagered").cast("double").alias("total_wagered"),
        ratio((F.col("n_before") + F.col("_rn")) * 100.0, "n_all").alias("player_pct"),
        ratio(cumulative * 100.0, "amount_all").alias("cumulative_pct"),
    )


def top_share(tx: DataFrame, top_pct: float = 20) -> DataFrame:
    """What the top share of players wagered, in percent of all."""
    return pareto_curve(tx).agg(
        F.max(F.when(F.col("player_pct") <= top_pct, F.col("cumulative_pct"))).alias("top_share")
    )


def _bet_profile(tx: DataFrame, key: str) -> DataFrame:
    return tx.groupBy(key).agg(
        money_sum("bet_amount").alias("total_wagered"),
        F.count("bet_amount").alias("num_bets"),
        mean("bet_amount").alias("avg_bet"),
    )


def hourly_profile(tx: DataFrame) -> DataFrame:
    """G13."""
    return _bet_profile(tx, "hour")


def weekday_profile(tx: DataFrame) -> DataFrame:
    """By weekday (0 = Monday) with its name."""
    return _bet_profile(tx, "day_of_week").withColumn(
        "day_name", calendar.day_name(F.col("day_of_week"))
    )


def weekend_split(tx: DataFrame) -> DataFrame:
    """G15."""
    return _bet_profile(tx, "is_weekend")


def peak_split(tx: DataFrame) -> DataFrame:
    """G16."""
    return _bet_profile(tx, "is_peak_hour").drop("num_bets")


def histogram(
    df: DataFrame,
    value: str,
    bins: int = 100,
    low: float | None = None,
    high: float | None = None,
) -> DataFrame:
    """Counts in equal-width bins between the smallest and the largest value.

    ``low`` and ``high`` clip the values at these quantiles first.  Equal values
    are counted once; quantiles, ends and bins all start from those counts.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(as_double(value).alias("x"))
        .agg(F.count("*").alias("n"))
    )
    if low is not None or high is not None:
        counts = rows.winsorise(counts, "x", low, high, out="x", weight="n")
    # Naming ``n`` keeps this the same aggregate as above, so its shuffle is reused.
    ends = counts.where("n > 0").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    spread = counts.withColumn("_ends", ends.select(F.struct("*")).scalar())
    start, end = F.col("_ends.low"), F.col("_ends.high")
    place = F.coalesce(F.floor(ratio(F.col("x") - start, end - start) * bins), F.lit(0))
    # The largest value belongs to the last bin.
    bin_no = F.least(place, F.lit(bins - 1)).cast("int")
    width = (F.col("high") - F.col("low")) / bins
    return (
        spread.select(bin_no.alias("bin"), start.alias("low"), end.alias("high"), "n")
        .groupBy("bin")
        .agg(F.sum("n").alias("count"), F.max("low").alias("low"), F.max("high").alias("high"))
        .select(
            "bin",
            (F.col("low") + F.col("bin") * width).alias("bin_start"),
            (F.col("low") + (F.col("bin") + 1) * width).alias("bin_end"),
            "count",
        )
    )


def bet_histogram(tx: DataFrame, bins: int = 100, cap: float = 0.99) -> DataFrame:
    """G17 on bets clipped at their ``cap`` quantile."""
    return histogram(tx, "bet_amount", bins, high=cap)


def multiplier_histogram(tx: DataFrame, bins: int = 50, cap: float = 0.99) -> DataFrame:
    """G17 on payout over stake of winning bets."""
    return histogram(rows.win_multipliers(tx), "multiplier", bins, high=cap)


def net_histogram(
    tx: DataFrame, bins: int = 100, low: float = 0.01, high: float = 0.99
) -> DataFrame:
    """G17 on net results clipped at both ends."""
    return histogram(tx, "net_result", bins, low, high)


def _log_moments(tx: DataFrame, cap: float) -> DataFrame:
    clipped = rows.winsorise(tx.where(F.col("bet_amount") > 0), "bet_amount", None, cap, "x")
    return clipped.agg(
        F.avg(F.ln("x")).alias("mu"),
        F.stddev_samp(F.ln("x")).alias("sigma"),
        F.count("x").alias("n"),
        F.min("x").alias("low"),
        F.max("x").alias("high"),
    )


def lognormal_fit(tx: DataFrame, cap: float = 0.99) -> DataFrame:
    """Moments of the logarithm of clipped bets."""
    return _log_moments(tx, cap).select("mu", "sigma")


def lognormal_curve(tx: DataFrame, cap: float = 0.99, points: int = 100) -> DataFrame:
    """The fitted density at even points, scaled to counts per histogram bin."""
    fit = _log_moments(tx, cap)
    grid = fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    span = F.col("high") - F.col("low")
    x = F.col("low") + span * F.col("point") / (points - 1)
    z = (F.ln("x") - F.col("mu")) / F.col("sigma")
    density = F.exp(-z * z / 2) / (F.col("x") * F.col("sigma") * F.sqrt(F.lit(2.0) * F.pi()))
    return grid.withColumn("x", x).select(
        "point", "x", (density * F.col("n") * span / points).alias("expected_count")
    )


def distribution_summary(tx: DataFrame) -> DataFrame:
    """One row of bet, win and net-result statistics."""
    bet, win, net = F.col("bet_amount"), F.col("win_amount"), F.col("net_result")
    median = scans.exact_quantiles(tx, "bet_amount", {"m": 0.5}).scalar()
    return tx.agg(
        mean("bet_amount").alias("bet_mean"),
        F.stddev_samp(as_double(bet)).alias("bet_std"),
        sample_skewness("bet_amount").alias("bet_skew"),
        (ratio(F.count_if(win > 0), F.count("*")) * 100).alias("hit_rate"),
        mean(F.when(win > 0, win)).alias("avg_win"),
        F.max(as_double(win)).alias("max_win"),
        (ratio(0 - money_sum(net), money_sum(bet)) * 100).alias("house_edge"),
        mean("net_result").alias("net_mean"),
        (0 - money_sum(net)).alias("total_ggr"),
        F.count_if(net > 0).alias("win_count"),
        F.count_if(net < 0).alias("loss_count"),
    ).withColumn("bet_median", median)
