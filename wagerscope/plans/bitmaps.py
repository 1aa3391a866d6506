"""Activity bitmaps: one row per player with a bit for every month they played.

Months are numbered from January 1970 (month 0), so every bit has the same
meaning in every table and no scan is needed to fix an origin.  Month ``m`` is
bit ``m % 64`` of word ``m // 64``; a player's words are a map from word number
to a 64-bit mask, with the first and last active month beside them.

The table is built in one pass over the log: bets fold map-side into one mask
per (player, word), then per player.  Cohort questions are then answered from
one row per player without joins or distinct counts: a player is active ``k``
months after joining when bit ``cohort + k`` is set, so a cohort's active
players at ``k`` is the sum of that bit over its players (a popcount across
rows), for every ``k`` in the same aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerscope.functions.metrics import pct, ratio


def month_number(date: Column) -> Column:
    """Months since January 1970 of a date."""
    return (F.year(date) - 1970) * 12 + F.month(date) - 1


def month_start(number: Column) -> Column:
    """The first day of month ``number``."""
    return F.make_date(F.floor(number / 12) + 1970, number % 12 + 1, F.lit(1))


def month_bitmaps(tx: DataFrame, date: str = "date") -> DataFrame:
    """``player_id, cohort, last, words``: active months of every player.

    ``cohort`` and ``last`` are the first and last active month numbers.  Bets
    without a date or player are left out (they have no month or no player).
    """
    m = month_number(F.col(date))
    per_word = (
        tx.where(F.col(date).isNotNull() & F.col("player_id").isNotNull())
        .select("player_id", m.alias("m"))
        .groupBy("player_id", F.floor(F.col("m") / 64).cast("int").alias("w"))
        .agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("m") % 64).cast("int"))).alias("bits"),
            F.min("m").alias("first"),
            F.max("m").alias("last"),
        )
    )
    return per_word.groupBy("player_id").agg(
        F.min("first").cast("int").alias("cohort"),
        F.max("last").cast("int").alias("last"),
        F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("words"),
    )


def active(month: Column) -> Column:
    """1 if bit ``month`` is set in the row's ``words``, else 0."""
    word = F.coalesce(F.element_at(F.col("words"), F.floor(month / 64).cast("int")), F.lit(0).cast("long"))
    return F.call_function("shiftright", word, (month % 64).cast("int")).bitwiseAND(F.lit(1))


def span(bitmaps: DataFrame) -> int:
    """Most months between a player's first and last activity, plus one (0 if none)."""
    most = bitmaps.agg(F.max(F.col("last") - F.col("cohort"))).first()[0]
    return 0 if most is None else int(most) + 1


def cohort_retention(bitmaps: DataFrame, max_months: int | None = None) -> DataFrame:
    """L5 from bitmaps: ``cohort_month, months_since_acquisition, active_players,
    cohort_size, retention_pct, retention_rate`` for every index with an active player.

    One aggregate over one row per player computes every index at once; the
    number of indexes (the longest span of a player, one number from the data,
    at most ``max_months + 1``) is the only value that reaches the driver.
    """
    width = span(bitmaps)
    if max_months is not None:
        width = min(width, max_months + 1)
    if width == 0:
        return bitmaps.sparkSession.createDataFrame(
            [], "cohort_month date, months_since_acquisition int, active_players long, cohort_size long, "
            "retention_pct double, retention_rate double")
    counts = [F.sum(active(F.col("cohort") + k)).alias(f"k{k}") for k in range(width)]
    per_cohort = bitmaps.groupBy("cohort").agg(F.count("*").alias("cohort_size"), *counts)
    cells = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("n")) for k in range(width)])
    laid = per_cohort.select("cohort", "cohort_size", F.inline(cells)).where(F.col("n") > 0)
    return laid.select(
        month_start(F.col("cohort")).alias("cohort_month"),
        F.col("k").cast("int").alias("months_since_acquisition"),
        F.col("n").cast("long").alias("active_players"),
        F.col("cohort_size").cast("long").alias("cohort_size"),
        pct(F.col("n"), F.col("cohort_size")).alias("retention_pct"),
        ratio("n", "cohort_size").alias("retention_rate"),
    )


def cohort_matrix(bitmaps: DataFrame, max_months: int = 12) -> DataFrame:
    """L6 from bitmaps: one row per cohort with ``month_0`` .. ``month_<max_months>`` in percent.

    An index where nobody of the cohort played is null, as in the pivot.
    """
    size = F.count("*")
    cells = [
        F.when(F.sum(active(F.col("cohort") + k)) > 0, pct(F.sum(active(F.col("cohort") + k)), size)).alias(
            f"month_{k}")
        for k in range(max_months + 1)
    ]
    return bitmaps.groupBy("cohort").agg(size.alias("cohort_size"), *cells).select(
        month_start(F.col("cohort")).alias("cohort_month"),
        "cohort_size",
        *[f"month_{k}" for k in range(max_months + 1)],
    )
