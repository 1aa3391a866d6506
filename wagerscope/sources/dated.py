"""The dated store: the typed log kept as one folder per day.

Jobs read the typed log from here instead of parsing text again.  A batch of
days is written with dynamic partition overwrite: the days it holds replace
those days in the store, every other day stays as it is.  New days are added
that way, and a late or corrected day is written again whole without touching
the rest, so a rerun of any load is harmless.

Look-backs read a window of days: the reference day is a literal (the one
given, or the store's last day, found from the partition column alone), so the
date filter is a partition filter and the scan opens only the window's
folders.  Inside a day, rows are sorted by player, so row groups of a day can
be skipped for one player.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_days(tx: DataFrame, path: str, date: str = "date", key: str = "player_id") -> None:
    """Put the days of ``tx`` into the store at ``path``; other days stay.

    Rows are dealt by ranges of (day, player), so a day with a third of all rows
    is written by many tasks and no task holds more than its share; each task
    writes one file per day of its range.  Rows with a null day go to Spark's
    default partition folder and read back as null.  An empty ``tx`` changes
    nothing.  Columns keep their names and types; ``date`` is read back as a date.
    """
    (
        tx.repartitionByRange(date, key)
        .sortWithinPartitions(date, key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date)
        .parquet(path)
    )


def latest_day(spark: SparkSession, path: str, date: str = "date") -> dt.date | None:
    """The last day in the store; reads the partition column only (no data pages)."""
    return spark.read.parquet(path).agg(F.max(date)).first()[0]


def read_days(
    spark: SparkSession,
    path: str,
    days: int | None = None,
    as_of: dt.date | str | None = None,
    date: str = "date",
) -> tuple[DataFrame, dt.date | None]:
    """The store's rows from ``days`` days before the reference day on, and that day.

    The reference day is ``as_of``, else the store's last day; it is returned so
    operators can take it as their own ``as_of`` and never scan for it again.
    ``days=None`` reads every day.  The same rows as ``calendar.look_back``.
    """
    store = spark.read.parquet(path)
    anchor = as_of if as_of is not None else latest_day(spark, path, date)
    if isinstance(anchor, str):
        anchor = dt.date.fromisoformat(anchor)
    if days is None or anchor is None:
        return store, anchor
    return store.where(F.col(date) >= F.lit(anchor - dt.timedelta(days=days))), anchor


def load_in_batches(tx: DataFrame, path: str, cuts: list[dt.date], date: str = "date") -> None:
    """Write ``tx`` as consecutive day ranges split at ``cuts``, each its own job."""
    bounds = [None, *sorted(cuts), None]
    for low, high in zip(bounds, bounds[1:], strict=False):
        part = tx
        if low is not None:
            part = part.where(F.col(date) >= F.lit(low))
        if high is not None:
            part = part.where(F.col(date) < F.lit(high))
        write_days(part, path, date)
