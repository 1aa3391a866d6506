"""Column contracts of the tables the operators read."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# What a bet log file holds: text everywhere, typed later by ``sources.files.silver``.
BRONZE_COLUMNS = (
    "transaction_id",
    "player_id",
    "game_id",
    "timestamp",
    "bet_amount",
    "win_amount",
    "net_result",
    "session_id",
    "session_balance",
    "consecutive_losses",
    "consecutive_wins",
    "hour",
    "day_of_week",
    "day_of_month",
    "month",
    "is_weekend",
    "is_peak_hour",
    "is_payday",
    "date",
)
BRONZE = T.StructType([T.StructField(c, T.StringType()) for c in BRONZE_COLUMNS])

TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("player_id", T.StringType()),
        T.StructField("game_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("bet_amount", MONEY),
        T.StructField("win_amount", MONEY),
        T.StructField("net_result", MONEY),
        T.StructField("session_id", T.StringType()),
        T.StructField("session_balance", MONEY),
        T.StructField("consecutive_losses", T.IntegerType()),
        T.StructField("consecutive_wins", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("day_of_month", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("is_weekend", T.IntegerType()),
        T.StructField("is_peak_hour", T.IntegerType()),
        T.StructField("is_payday", T.IntegerType()),
        T.StructField("date", T.DateType()),
    ]
)

# A row without one of these cannot be placed in any table and is rejected at load.
REQUIRED = ("transaction_id", "player_id", "game_id", "timestamp", "bet_amount", "session_id")

# The first header of the games file is empty: it holds the game's name.
GAMES = T.StructType(
    [
        T.StructField("game_name", T.StringType()),
        T.StructField("game_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("rtp", T.DoubleType()),
        T.StructField("volatility", T.StringType()),
        T.StructField("min_bet", T.DoubleType()),
        T.StructField("max_bet", T.IntegerType()),
        T.StructField("hit_frequency", T.DoubleType()),
        T.StructField("max_multiplier", T.DoubleType()),
        T.StructField("bonus_frequency", T.DoubleType()),
        T.StructField("visual_engagement", T.DoubleType()),
    ]
)

# The game catalogue shipped with the data model.
GAME_ROWS = [
    ("SLOT_FORTUNE", "G001", "slot", 0.96, "high", 0.2, 500, 0.25, 5000.0, 0.008, 0.85),
    ("BLACKJACK_LIVE", "G002", "table", 0.995, "low", 5.0, 2000, 0.42, 2.5, 0.0, 0.7),
    ("ROULETTE_EURO", "G003", "table", 0.973, "medium", 1.0, 1000, 0.486, 35.0, 0.0, 0.65),
    ("SLOT_CLASSIC", "G004", "slot", 0.94, "medium", 0.1, 100, 0.35, 1000.0, 0.015, 0.6),
]

# Value segments from the most to the least valuable.
SEGMENTS = ("Whale", "VIP", "High", "Regular", "Casual")
