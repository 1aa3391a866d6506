"""Row-level derivations and filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerscope.functions import calendar, scans
from wagerscope.functions.metrics import ratio
from wagerscope.schema import MONEY


_BALANCE = {"net_result": "session_balance"}


def _outcome_runs() -> tuple[Column, str, str]:
    return F.col("win_amount") > 0, "consecutive_losses", "consecutive_wins"


def calendar_columns(
    tx: DataFrame,
    peak_hours: tuple[int, int] = calendar.PEAK_HOURS,
    paydays: Sequence[int] = calendar.PAYDAYS,
) -> DataFrame:
    """Hour, day_of_week (0 = Monday), day_of_month, month, flags and date."""
    ts = F.col("timestamp")
    return tx.withColumns(
        {
            "hour": F.hour(ts),
            "day_of_week": F.weekday(ts),
            "day_of_month": F.dayofmonth(ts),
            "month": F.month(ts),
            "is_weekend": F.weekday(ts).isin(5, 6).cast("int"),
            "is_peak_hour": F.hour(ts).between(*peak_hours).cast("int"),
            "is_payday": F.dayofmonth(ts).isin(*paydays).cast("int"),
            "date": F.to_date(ts),
        }
    )


def temporal_features(daily: DataFrame, date: str = "date") -> DataFrame:
    """Calendar features of a daily table; day_of_week here is 1 = Sunday."""
    d = F.col(date)
    launch = daily.agg(F.min(date)).scalar()
    return daily.withColumns(
        {
            "days_from_launch": F.datediff(d, launch),
            "year": F.year(d),
            "month": F.month(d),
            "day_of_month": F.dayofmonth(d),
            "day_of_week": F.dayofweek(d),
            "week_of_year": F.weekofyear(d),
            "is_weekend": F.dayofweek(d).isin(1, 7).cast("int"),
            "is_month_start": F.dayofmonth(d).isin(1, 2, 3).cast("int"),
            "is_month_mid": F.dayofmonth(d).isin(14, 15, 16, 17).cast("int"),
        }
    )


def net_result(tx: DataFrame) -> DataFrame:
    """What the player won minus what the player bet."""
    return tx.withColumn(
        "net_result", F.round(F.col("win_amount") - F.col("bet_amount"), 2).cast(MONEY)
    )


def running_balance(tx: DataFrame, slice_seconds: int = scans.SLICE_SECONDS) -> DataFrame:
    """P5: the session's net result up to and with each bet."""
    return scans.ordered_state(tx, sums=_BALANCE, slice_seconds=slice_seconds)


def streak_lengths(tx: DataFrame, slice_seconds: int = scans.SLICE_SECONDS) -> DataFrame:
    """Losses and wins in a row after each bet; any payout ends a losing run."""
    return scans.ordered_state(tx, runs=_outcome_runs(), slice_seconds=slice_seconds)


def session_sequence(tx: DataFrame, slice_seconds: int = scans.SLICE_SECONDS) -> DataFrame:
    """P5 and P6 together, in one pass."""
    return scans.ordered_state(
        tx, sums=_BALANCE, runs=_outcome_runs(), slice_seconds=slice_seconds
    )


def win_multipliers(tx: DataFrame) -> DataFrame:
    """Payout over stake for winning bets."""
    return tx.where(F.col("win_amount") > 0).withColumn(
        "multiplier", ratio("win_amount", "bet_amount")
    )


def winsorise(
    df: DataFrame,
    value: str,
    low: float | None,
    high: float | None,
    out: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Clip ``value`` at its interpolated quantiles ``low`` and ``high``.

    ``weight`` says how often each row counts.
    """
    probs = {}
    if low is not None:
        probs["low"] = low
    if high is not None:
        probs["high"] = high
    bounds = scans.exact_quantiles(df, value, probs, weight=weight).select(F.struct(*probs)).scalar()
    clipped = F.col(value).cast("double")
    if high is not None:
        clipped = F.least(clipped, bounds["high"])
    if low is not None:
        clipped = F.greatest(clipped, bounds["low"])
    kept = F.when(F.col(value).isNotNull(), clipped)
    return df.withColumn(out or f"{value}_clipped", kept)


def with_week_start(tx: DataFrame, ts: str = "timestamp") -> DataFrame:
    """P9 as a column."""
    return tx.withColumn("week_start", calendar.week_of(ts))


def with_cohort_index(
    tx: DataFrame, cohort_month: str = "cohort_month", mode: str = "calendar"
) -> DataFrame:
    """P11 as a column."""
    return tx.withColumn(
        "months_since_acquisition",
        calendar.month_index(calendar.month_of("date"), F.col(cohort_month), mode),
    )


def with_game_names(df: DataFrame, games: DataFrame) -> DataFrame:
    """The game's name; NULL where the games table does not list it."""
    return df.join(games.select("game_id", "game_name"), "game_id", "left")


def with_game_type(df: DataFrame, games: DataFrame) -> DataFrame:
    """All columns of ``df`` and only ``type`` of the games table."""
    base, g = df.alias("base"), games.alias("games")
    return base.join(g, F.col("base.game_id") == F.col("games.game_id"), "left").select(
        "base.*", "games.type"
    )


def minimum_activity(
    features: DataFrame, min_bets: int = 10, min_days: int = 2
) -> DataFrame:
    """Players with enough bets on enough days."""
    return features.where(
        (F.col("total_bets") >= min_bets) & (F.col("active_days") >= min_days)
    )


def date_range(df: DataFrame, start, end, col: str = "date") -> DataFrame:
    """Both ends included."""
    return df.where(F.col(col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def game_prefix(prefix: str, col: str = "game_id") -> Column:
    """Game ids starting with ``prefix``."""
    return F.col(col).startswith(prefix)


def label_contains(text: str, col: str = "label") -> Column:
    """Persona labels containing ``text``."""
    return F.col(col).contains(text)


def random_sample(df: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """A random share of the rows (the feature itself is a sample)."""
    return df.sample(fraction=fraction, seed=seed)


def stable_sample(df: DataFrame, key: str, percent: int = 10) -> DataFrame:
    """A share of the rows chosen by a hash of ``key``, the same in every run."""
    digest = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return df.where(digest % 100 < percent)


def fill_numeric(df: DataFrame, value: float = 0, cols: Iterable[str] | None = None) -> DataFrame:
    """NULL, NaN and infinite numbers become ``value``."""
    wanted = None if cols is None else set(cols)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.NumericType) and (wanted is None or f.name in wanted):
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                bad = F.isnan(c) | (F.abs(c) == float("inf"))
                c = F.when(bad, None).otherwise(c)
            c = F.coalesce(c, F.lit(value).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)
