"""Value segments by rules and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagerscope.functions import calendar, scans
from wagerscope.functions.metrics import mean, ratio
from wagerscope.schema import SEGMENTS

# The quantile a player must reach in both measures; the last
# segment takes everyone else.
LEVELS = {"whale": 0.99, "vip": 0.95, "high": 0.85, "regular": 0.60}
MEASURES = {"bet": "avg_bet_amount", "wager": "total_wagered"}


def light_features(
    tx: DataFrame, lookback_days: int | None = 90, min_bets: int = 10, as_of=None
) -> DataFrame:
    """M1: the few measures the rules need, for players with enough recent bets."""
    folded = (
        calendar.look_back(tx, lookback_days, as_of)
        .groupBy("player_id", "session_id", "date")
        .agg(
            F.count("*").alias("n"),
            F.sum("bet_amount").alias("wagered"),
            F.sum("net_result").alias("net"),
        )
    )
    counted = {"total_sessions": "session_id", "active_days": "date"}
    return (
        scans.sums_and_distinct(folded, ["player_id"], ["n", "wagered", "net"], counted)
        .select(
            "player_id",
            ratio("wagered", "n").alias("avg_bet_amount"),
            F.col("wagered").cast("double").alias("total_wagered"),
            "total_sessions",
            "active_days",
            F.abs(F.col("net").cast("double")).alias("total_net_loss"),
            F.col("n").alias("total_bets"),
        )
        .where(F.col("total_bets") >= min_bets)
        .withColumn("analysis_date", calendar.anchor(tx, as_of))
    )


def segment_thresholds(
    features: DataFrame, exact: bool = False, accuracy: int = 10_000
) -> DataFrame:
    """M2: one row with the quantiles of average bet and total wagered.

    Nearest-rank from a mergeable sketch, or interpolated when ``exact``.
    """
    if exact:
        parts = [
            scans.exact_quantiles(
                features, col, {f"{lvl}_{m}_threshold": p for lvl, p in LEVELS.items()}
            )
            for m, col in MEASURES.items()
        ]
        bet, wager = [p.select(F.struct("*").alias("s")).scalar() for p in parts]
        one = features.sparkSession.range(1).select(bet.alias("bet"), wager.alias("wager"))
        return one.select("bet.*", "wager.*")
    picks = list(LEVELS.values())
    sketches = features.agg(
        *[F.percentile_approx(col, picks, accuracy).alias(m) for m, col in MEASURES.items()]
    )
    return sketches.select(
        *[
            F.get(F.col(m), F.lit(i)).alias(f"{lvl}_{m}_threshold")
            for m in MEASURES
            for i, lvl in enumerate(LEVELS)
        ]
    )


def assign_segments(
    features: DataFrame, exact: bool = False, accuracy: int = 10_000
) -> DataFrame:
    """M3: the first segment whose limits a player reaches in both measures."""
    limits = segment_thresholds(features, exact, accuracy).select(F.struct("*")).scalar()
    tagged = features.withColumn("_limits", limits)
    segment: Column = F.lit(SEGMENTS[-1])
    for level, name in reversed(list(zip(LEVELS, SEGMENTS))):
        reached = F.lit(True)
        for m, col in MEASURES.items():
            reached = reached & (F.col(col) >= F.col("_limits")[f"{level}_{m}_threshold"])
        segment = F.when(reached, name).otherwise(segment)
    return tagged.withColumn("player_segment", segment).drop("_limits")


def player_segments(
    tx: DataFrame,
    lookback_days: int | None = 90,
    min_bets: int = 10,
    as_of=None,
    exact: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """M1-M3: the segment table, one row per player."""
    out = assign_segments(light_features(tx, lookback_days, min_bets, as_of), exact).select(
        "player_id",
        "avg_bet_amount",
        "total_wagered",
        "total_sessions",
        "active_days",
        "player_segment",
        "analysis_date",
    )
    return out.orderBy(F.desc("total_wagered")) if ordered else out


def segment_sizes(segmented: DataFrame) -> DataFrame:
    """Players and mean bet per segment."""
    return segmented.groupBy("player_segment").agg(
        F.count("*").alias("players"), mean("avg_bet_amount").alias("avg_bet_amount")
    )


def segment_summary(segmented: DataFrame) -> DataFrame:
    """Totals and means per segment, rounded to cents."""

    def two(c: Column) -> Column:
        return F.round(c, 2)

    return segmented.groupBy("player_segment").agg(
        F.count("player_id").alias("players"),
        two(F.sum("total_wagered")).alias("total_wagered"),
        two(F.sum("total_net_loss")).alias("total_ggr"),
        two(F.avg("avg_bet_amount")).alias("avg_bet"),
        two(F.avg("sessions_per_day")).alias("sessions_per_day"),
    )


def revenue_concentration(segmented: DataFrame) -> DataFrame:
    """Each segment's share of players and of revenue."""
    per_segment = segmented.groupBy("player_segment").agg(
        F.count("*").alias("players"), F.sum("total_net_loss").alias("revenue")
    )
    every = Window.partitionBy()
    return per_segment.select(
        "player_segment",
        ratio(F.col("players") * 100.0, F.sum("players").over(every)).alias("pct_players"),
        ratio(F.col("revenue") * 100.0, F.sum("revenue").over(every)).alias("pct_revenue"),
    )
