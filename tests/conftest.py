import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from wagerscope.operators import rows  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .config("spark.checkpoint.dir", str(home / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def make_tx(spark):
    """Bets from (player, session, 'yyyy-mm-dd hh:mm:ss', game, bet, win) tuples."""

    def build(bets, sequence=True, slice_seconds=3600):
        data = [
            (
                f"T{i:05d}", p, s, dt.datetime.fromisoformat(ts), g,
                Decimal(str(bet)), Decimal(str(win)),
            )
            for i, (p, s, ts, g, bet, win) in enumerate(bets)
        ]
        tx = spark.createDataFrame(
            data,
            "transaction_id string, player_id string, session_id string, timestamp timestamp, "
            "game_id string, bet_amount decimal(18,2), win_amount decimal(18,2)",
        )
        tx = rows.calendar_columns(rows.net_result(tx))
        return rows.session_sequence(tx, slice_seconds) if sequence else tx

    return build


def by(df, *keys):
    """Rows as dicts keyed by the values of ``keys``."""
    out = {}
    for r in df.collect():
        k = tuple(r[c] for c in keys)
        out[k if len(k) > 1 else k[0]] = r.asDict()
    return out
