"""Small activity tables most operators start from.

Each folds the bet log once, map-side first, to a size bounded by players times
calendar, so the joins and windows after it never see single bets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerscope.functions import calendar


def player_bounds(tx: DataFrame) -> DataFrame:
    """First and last day of each player."""
    return tx.groupBy("player_id").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


def player_days(tx: DataFrame, *more_keys: str) -> DataFrame:
    """Additive measures per player and day (and session, game ... if asked)."""
    net = F.col("net_result")
    return tx.groupBy("player_id", "date", *more_keys).agg(
        F.count("*").alias("bets"),
        F.sum("bet_amount").alias("wagered"),
        F.sum("win_amount").alias("winnings"),
        F.sum("net_result").alias("net_result"),
        F.sum(F.when(net < 0, -net).otherwise(F.lit(0))).alias("lost"),
    )


def player_months(tx: DataFrame) -> DataFrame:
    """Additive measures per player and calendar month."""
    net = F.col("net_result")
    return tx.groupBy("player_id", calendar.month_of("date").alias("month")).agg(
        F.count("*").alias("bets"),
        F.sum("bet_amount").alias("wagered"),
        F.sum("net_result").alias("net_result"),
        F.sum(F.when(net < 0, -net).otherwise(F.lit(0))).alias("lost"),
    )
