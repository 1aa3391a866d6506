"""Month bitmaps give the same cohorts, retention and matrix as the active-month tables."""

from wagerscope.operators import lifecycle
from wagerscope.plans import bitmaps


def rows_of(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_bitmaps_match_active_months(make_tx):
    bets = []
    for p in range(6):
        for k in range(0, 90, p + 1):  # 90 months: two words of bits
            year, month = 2015 + (p + k) // 12, (p + k) % 12 + 1
            bets.append((f"P{p}", f"S{p}-{k}", f"{year}-{month:02d}-0{1 + k % 5} 10:00:00", "G001", 5, 0))
    bets.append(("P0", "S0-x", "2015-01-03 11:00:00", "G001", 5, 10))  # a second bet in one month
    tx = make_tx(bets, sequence=False)
    bm = bitmaps.month_bitmaps(tx)
    assert rows_of(bitmaps.cohort_retention(bm)) == rows_of(lifecycle.cohort_retention(tx, max_months=None))
    assert rows_of(bitmaps.cohort_matrix(bm)) == rows_of(lifecycle.cohort_matrix(tx))
    assert rows_of(bitmaps.cohort_retention(bm, 12)) == rows_of(lifecycle.cohort_retention(tx, 12))


def test_empty_log(spark, make_tx):
    tx = make_tx([("P", "S", "2020-01-01 00:00:00", "G001", 1, 0)], sequence=False).limit(0)
    bm = bitmaps.month_bitmaps(tx)
    assert bitmaps.cohort_retention(bm).count() == 0
    assert bitmaps.cohort_matrix(bm).count() == 0
