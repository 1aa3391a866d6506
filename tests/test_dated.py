"""The dated store: batches and a late day add up to the whole log; look-backs prune."""

import datetime as dt

from pyspark.sql import functions as F

from wagerscope.operators import segments
from wagerscope.sources import dated


def bets(make_tx):
    rows = []
    for day in range(1, 21):
        for p in range(3):
            rows.append((f"P{p}", f"S{p}-{day}", f"2024-03-{day:02d} 1{p}:00:00", "G001", 10 + p, day % 3 * 5))
    rows.append(("P9", "S9", "2024-03-07 09:00:00", "G002", 100, 0))  # one heavy player, one day
    return make_tx(rows, sequence=False)


def as_rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_batches_and_late_day_equal_whole(spark, make_tx, tmp_path):
    tx = bets(make_tx)
    path = str(tmp_path / "store")
    late = dt.date(2024, 3, 7)
    # the first load misses a late file of March 7th
    early = tx.where(~((F.col("date") == F.lit(late)) & (F.col("player_id") == "P9")))
    dated.load_in_batches(early, path, [dt.date(2024, 3, 11)])
    dated.write_days(tx.where(F.col("date") == F.lit(late)), path)  # the day again, whole
    dated.write_days(tx.where(F.col("date") == F.lit(late)), path)  # a rerun changes nothing
    store, anchor = dated.read_days(spark, path)
    assert anchor == dt.date(2024, 3, 20)
    assert as_rows(store.select(tx.columns)) == as_rows(tx)


def test_look_back_prunes_and_matches(spark, make_tx, tmp_path):
    tx = bets(make_tx)
    path = str(tmp_path / "store")
    dated.write_days(tx, path)
    store, anchor = dated.read_days(spark, path, days=5)
    plan = store._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-03-15" in plan
    assert store.select("date").distinct().count() == 6
    whole = segments.light_features(tx, 5, min_bets=1)
    stored = segments.light_features(store, 5, min_bets=1, as_of=anchor)
    assert as_rows(whole) == as_rows(stored)
