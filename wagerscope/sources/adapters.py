"""Bet logs derived from the star-schema test tables.

``bets`` comes from the event stream (one month, hour-level play), ``ledger``
from order lines (seven years, month-level play).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerscope import schema
from wagerscope.functions import scans
from wagerscope.operators import rows

# Which game an event type stands for; ``error`` maps to a game
# that the games table does not list.
GAME_OF_EVENT = {
    "view": "G001",
    "click": "G002",
    "purchase": "G003",
    "signup": "G004",
    "error": "G005",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def games(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(schema.GAME_ROWS, schema.GAMES)


def _win(factor, bet):
    return (bet * factor).cast(schema.MONEY)


def bets(spark: SparkSession, sf_dir: str, sequence: bool = False) -> DataFrame:
    """The event stream as bets.  ``sequence`` adds running balance and streaks."""
    bet = F.col("value").cast(schema.MONEY)
    k = F.get_json_object("props", "$.k").cast("int")
    factor = F.when(k < 60, 0).when(k < 70, 1).when(k < 95, 2).otherwise(5)
    game = F.lit(None)
    for event, game_id in GAME_OF_EVENT.items():
        game = F.when(F.col("event_type") == event, game_id).otherwise(game)
    base = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("player_id"),
        game.alias("game_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        bet.alias("bet_amount"),
        _win(factor, bet).alias("win_amount"),
    )
    numbered = scans.sessionize(base)
    tx = numbered.withColumn(
        "session_id", F.concat_ws("-", "player_id", "session_no")
    ).drop("session_no")
    tx = rows.calendar_columns(rows.net_result(tx))
    return rows.session_sequence(tx) if sequence else tx


def ledger(spark: SparkSession, sf_dir: str, sequence: bool = False) -> DataFrame:
    """Order lines as bets: customer = player, order = session, part type = game."""
    bet = F.col("l_extendedprice").cast(schema.MONEY)
    factor = F.when(F.col("l_returnflag") == "R", 2).when(F.col("l_returnflag") == "A", 1).otherwise(0)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    # Orders come last: bets stay in slices by session, where they can be folded as they are.
    listed = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    tx = (
        scans.sliced(listed, "l_orderkey")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.concat_ws(
                "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", bet.cast("string")
            ).alias("transaction_id"),
            F.col("o_custkey").alias("player_id"),
            F.col("p_type").alias("game_id"),
            F.col("l_shipdate").cast("timestamp").alias("timestamp"),
            bet.alias("bet_amount"),
            _win(factor, bet).alias("win_amount"),
            F.col("l_orderkey").alias("session_id"),
        )
    )
    tx = rows.calendar_columns(rows.net_result(tx))
    # An order's lines ship over months, so its slices are months long.
    return rows.session_sequence(tx, slice_seconds=30 * 86_400) if sequence else tx


def market_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table's own grouping, as a segment table."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("player_id"), F.col("c_mktsegment").alias("player_segment")
    )
