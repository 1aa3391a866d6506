"""Sequencing in loads with a carried state equals sequencing the whole log."""

import datetime as dt

from pyspark.sql import functions as F

from wagerscope.functions import carry, scans

def spec():
    return {
        "sums": {"net_result": "session_balance"},
        "previous": {"bet_amount": "prev_bet"},
        "runs": (F.col("win_amount") > 0, "consecutive_losses", "consecutive_wins"),
    }
COLS = ["transaction_id", "session_balance", "prev_bet", "consecutive_losses", "consecutive_wins"]


def test_three_loads_equal_whole(make_tx):
    bets = []
    for i in range(60):  # one session over three days, runs crossing both cuts
        win = 10 if i % 7 in (5, 6) else 0
        bets.append(("P1", "S1", f"2024-03-0{1 + i // 20} {10 + i % 20 // 2}:{i % 2 * 30:02d}:00", "G001", 5 + i, win))
    bets += [("P2", "S2", "2024-03-01 10:00:00", "G002", 3, 0), ("P2", "S3", "2024-03-03 10:00:00", "G002", 4, 9)]
    tx = make_tx(bets, sequence=False)
    whole = scans.ordered_state(tx, **spec()).select(COLS)
    state, parts = None, []
    for day in (1, 2, 3):
        rows, state = carry.sequenced(tx.where(F.col("date") == F.lit(dt.date(2024, 3, day))), state, **spec())
        parts.append(rows.select(COLS))
    got = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
