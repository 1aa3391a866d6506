"""Row-level operators, including the sliced scans against plain Python."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import by
from pyspark.sql import functions as F

from wagerscope.functions import calendar, scans
from wagerscope.functions.metrics import ggr, ratio, sample_skewness
from wagerscope.operators import rows


def _session(outcomes, start="2024-01-01 10:00:00", step=60):
    """One session of 10-unit bets: W doubles, P pushes, L loses."""
    t = dt.datetime.fromisoformat(start)
    win = {"W": 20, "P": 10, "L": 0}
    return [
        ("p1", "s1", str(t + dt.timedelta(seconds=i * step)), "G001", 10, win[o])
        for i, o in enumerate(outcomes)
    ]


@pytest.mark.parametrize("slice_seconds", [60, 150, 3600])
def test_streaks_push_ends_losing_run(make_tx, slice_seconds):
    tx = make_tx(_session("LLPWL"), slice_seconds=slice_seconds).orderBy("timestamp")
    got = [(r.consecutive_losses, r.consecutive_wins, float(r.session_balance)) for r in tx.collect()]
    assert got == [(1, 0, -10), (2, 0, -20), (0, 1, -20), (0, 2, -10), (1, 0, -20)]


def test_ordered_state_matches_plain_loop_with_a_hot_key(make_tx):
    rng = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    bets = []
    for _ in range(400):
        hot = rng.random() < 0.4
        player = "hot" if hot else f"p{rng.randrange(6)}"
        session = "one" if hot else f"{player}-{rng.randrange(3)}"
        when = t0 + dt.timedelta(seconds=rng.randrange(20_000))
        bets.append((player, session, str(when), "G001", rng.randrange(1, 50), rng.choice([0, 0, 7, 90])))
    tx = make_tx(bets, sequence=False)
    out = scans.ordered_state(
        tx,
        sums={"net_result": "bal"},
        previous={"bet_amount": "prev"},
        runs=(F.col("win_amount") > 0, "losses", "wins"),
        slice_seconds=500,
    )
    state, want = {}, {}
    ordered = sorted(enumerate(bets), key=lambda e: (e[1][2], e[0]))
    for i, (p, s, _, _, bet, win) in ordered:
        bal, prev, losses, wins = state.get((p, s), (0, None, 0, 0))
        bal += win - bet
        losses, wins = (0, wins + 1) if win > 0 else (losses + 1, 0)
        want[f"T{i:05d}"] = (bal, prev, losses, wins)
        state[(p, s)] = (bal, bet, losses, wins)
    got = {
        r.transaction_id: (float(r.bal), None if r.prev is None else float(r.prev), r.losses, r.wins)
        for r in out.collect()
    }
    assert got == want


def test_sessions_break_only_after_a_longer_pause(spark):
    times = ["2024-01-01 00:00:00", "2024-01-01 12:00:00", "2024-01-02 00:00:01", "2024-01-05 00:00:00"]
    df = spark.createDataFrame([("a", t) for t in times], "player_id string, t string").select(
        "player_id", F.col("t").cast("timestamp").alias("timestamp")
    )
    got = [r.session_no for r in scans.sessionize(df).orderBy("timestamp").collect()]
    assert got == [1, 1, 2, 3]


def test_exact_quantiles_match_linear_interpolation(spark):
    rng = random.Random(3)
    values = [round(rng.lognormvariate(3, 2), 2) * rng.choice([1, -1]) for _ in range(500)]
    values += [5.0] * 200
    df = spark.createDataFrame(
        [("a" if i % 3 else "b", v) for i, v in enumerate(values)], "k string, v double"
    )
    probs = {"lo": 0.013, "mid": 0.5, "hi": 0.97, "min": 0.0, "max": 1.0}
    for key, row in by(scans.exact_quantiles(df, "v", probs, by=["k"]), "k").items():
        mine = sorted(v for i, v in enumerate(values) if ("a" if i % 3 else "b") == key)
        for name, p in probs.items():
            at = p * (len(mine) - 1)
            low = int(at)
            high = min(low + 1, len(mine) - 1)
            assert row[name] == pytest.approx(mine[low] + (mine[high] - mine[low]) * (at - low))


def test_value_ranges_grow_with_the_value(spark):
    rng = random.Random(5)
    values = sorted(
        {0.0, 1.0, 2.0, 3.0, 7.0, 8.0, 1e9} | {rng.uniform(-1e6, 1e6) for _ in range(2000)}
        | {2.0**i - 1 for i in range(40)} | {2.0**i - 1.0000001 for i in range(1, 40)}
    )
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", scans.value_range(F.col("v")).alias("r")).orderBy("v").collect()
    assert all(a.r <= b.r for a, b in zip(got, got[1:]))


def test_running_totals_with_ties_and_descending_order(spark):
    cells = [(9, "a", 1), (9, "b", 2), (5, "a", 4), (-3, "a", 8)]
    df = spark.createDataFrame(cells, "v int, t string, n int")
    out = by(scans.totals_before(df, "v", ["n"], tie=["t"], descending=True), "v", "t")
    assert {k: (r["n_before"], r["n_all"]) for k, r in out.items()} == {
        (9, "a"): (0, 15), (9, "b"): (1, 15), (5, "a"): (3, 15), (-3, "a"): (7, 15)
    }


def test_calendar_defaults(make_tx):
    tx = make_tx(
        [("p", "s", "2024-01-15 20:00:00", "G001", 1, 0), ("p", "s", "2024-01-06 19:59:59", "G001", 1, 0)],
        sequence=False,
    )
    a, b = tx.orderBy(F.desc("date")).collect()
    assert (a.hour, a.day_of_week, a.is_weekend, a.is_peak_hour, a.is_payday) == (20, 0, 0, 1, 1)
    assert (b.hour, b.day_of_week, b.is_weekend, b.is_peak_hour, b.is_payday) == (19, 5, 1, 0, 0)


def test_month_index_modes(spark):
    df = spark.sql(
        "SELECT explode(array(date'2024-02-01', date'2024-03-01', date'2024-05-01')) m"
    ).select(
        "m",
        calendar.month_index(F.col("m"), F.lit("2024-01-01").cast("date")).alias("exact"),
        calendar.month_index(
            F.col("m"), F.lit("2024-01-01").cast("date"), "days_30_44"
        ).alias("days"),
    )
    assert [(r.exact, r.days) for r in df.orderBy("m").collect()] == [(1, 1), (2, 1), (4, 3)]


def test_look_back_includes_the_first_day(make_tx):
    tx = make_tx(
        [("p", "s", f"2024-01-{d:02d} 00:00:00", "G001", 1, 0) for d in (1, 2, 9)], sequence=False
    )
    assert calendar.look_back(tx, 7).count() == 2
    assert calendar.look_back(tx, 7, "2024-01-08").count() == 3


def test_winsorise_clips_both_ends(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("v"))
    got = rows.winsorise(df, "v", 0.01, 0.99).agg(F.min("v_clipped"), F.max("v_clipped")).first()
    assert got[0] == pytest.approx(1.99) and got[1] == pytest.approx(99.01)


def test_fill_numeric_handles_nan_and_infinity(spark):
    df = spark.createDataFrame(
        [(float("nan"), None, "x"), (float("inf"), 3, None), (2.5, 4, "y")], "a double, b int, c string"
    )
    assert [tuple(r) for r in rows.fill_numeric(df).collect()] == [
        (0.0, 0, "x"), (0.0, 3, None), (2.5, 4, "y")
    ]


def test_ggr_definitions(spark):
    df = spark.createDataFrame([(Decimal("5"),), (Decimal("-3"),)], "net decimal(18,2)")
    modes = ["house", "losses", "absolute", "player", "house_or_zero"]
    row = df.agg(*[ggr("net", m).cast("double").alias(m) for m in modes]).first()
    assert tuple(row) == (-2.0, 3.0, 2.0, 2.0, 0.0)


def test_ratio_and_skewness_guards(spark):
    one = spark.range(1).select(ratio(F.lit(1), F.lit(0)).alias("n"), ratio(F.lit(1), F.lit(0), 0).alias("z"))
    assert tuple(one.first()) == (None, 0.0)
    two = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    assert two.agg(sample_skewness("v")).first()[0] is None
    four = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    assert four.agg(sample_skewness("v")).first()[0] == pytest.approx(1.7636324)


def test_stable_sample_is_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "transaction_id")
    a = {r[0] for r in rows.stable_sample(df, "transaction_id").collect()}
    b = {r[0] for r in rows.stable_sample(df.repartition(7), "transaction_id").collect()}
    assert a == b and 400 < len(a) < 600


def test_game_type_join_keeps_unknown_games(spark, make_tx):
    games = spark.createDataFrame([("G001", "slot")], "game_id string, type string")
    tx = make_tx(_session("L") + [("p1", "s1", "2024-01-01 11:00:00", "G009", 1, 0)], sequence=False)
    out = rows.with_game_type(tx, games)
    assert out.columns.count("game_id") == 1
    assert {(r.game_id, r.type) for r in out.collect()} == {("G001", "slot"), ("G009", None)}
