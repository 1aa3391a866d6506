"""Registered queries against their DuckDB twins on the smallest tables.

A spread of queries by default; ``WAGERSCOPE_ALL=1`` runs every one.
"""

import os

import duckdb
import pytest

from oracle import ORACLE
from wagerscope.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "customer events lineitem orders part".split()
SPREAD = [
    "calendar_columns", "player_streak_lengths", "ledger_running_balance", "exact_bet_quantiles",
    "daily_features", "training_features", "session_features", "player_segments",
    "daily_by_segment", "weekly_by_segment", "pareto_curve", "bet_histogram",
    "cohort_matrix", "pre_churn_behaviour", "weekly_churn", "run_statistics",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=str)


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE) if os.environ.get("WAGERSCOPE_ALL") else SPREAD)
def test_twin(spark, duck, name):
    answer = duck.execute(ORACLE[name])
    columns = [c[0] for c in answer.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.columns, got.collect()) == _rows(columns, answer.fetchall())
