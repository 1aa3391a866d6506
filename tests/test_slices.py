"""Tasks stay small: slices are not joined, distinct counts fold marks in slices, keys are read once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wagerscope import catalog
from wagerscope.functions import radix, scans
from wagerscope.operators import daily, lifecycle, segments
from wagerscope.sources import adapters


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """A small set of star-schema tables; order 0 has a null customer."""
    d = str(tmp_path_factory.mktemp("star"))
    n = F.col("id")
    spark.range(300).select(
        n.alias("o_orderkey"), F.when(n > 0, n % 7).alias("o_custkey")
    ).write.parquet(f"{d}/orders.parquet")
    spark.range(50).select(
        n.alias("p_partkey"), F.concat(F.lit("T"), (n % 3).cast("string")).alias("p_type")
    ).write.parquet(f"{d}/part.parquet")
    spark.range(6000).select(
        (n % 300).alias("l_orderkey"), (n % 50).alias("l_partkey"), (n % 9).alias("l_suppkey"),
        (n / 300).cast("int").alias("l_linenumber"), ((n % 101) + 0.25).alias("l_extendedprice"),
        F.when(n % 3 == 0, "R").when(n % 3 == 1, "A").otherwise("N").alias("l_returnflag"),
        F.timestamp_seconds(n * 7200 + 800_000_000).alias("l_shipdate"),
    ).write.parquet(f"{d}/lineitem.parquet")
    spark.range(600).select(
        n.alias("event_id"), (n % 11).alias("user_id"), F.lit("view").alias("event_type"),
        F.timestamp_seconds(n * 9000 + 1_704_067_200).alias("ts"), ((n % 40) + 0.5).alias("value"),
        F.format_string('{"k": %d}', n % 100).alias("props"),
    ).write.parquet(f"{d}/events.parquet")
    return d


@pytest.fixture
def small_slices(monkeypatch):
    monkeypatch.setattr(scans, "SLICE_BYTES", 2048)


def tasks(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_ledger_and_cohorts_stay_in_slices(spark, star, small_slices):
    tx = adapters.ledger(spark, star)
    assert tasks(tx) > 10
    assert tx.count() == 6000
    activity = lifecycle.cohort_activity(tx)
    assert tasks(activity) > 5  # seven players and the null one
    per_player = activity.groupBy("player_id").agg(F.countDistinct("cohort_month").alias("n"))
    assert [r.n for r in per_player.collect()] == [1] * 8


def test_tables_without_files_are_left_alone(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert scans.sliced(df, "a") is df


def test_features_equal_plain_distinct_counts(spark, star, small_slices, capsys):
    tx = adapters.ledger(spark, star)
    got = segments.light_features(tx, None, 1).select(
        "player_id", "total_sessions", "active_days", "total_wagered", "total_bets"
    )
    want = tx.groupBy("player_id").agg(
        F.count_distinct("session_id"), F.count_distinct("date"), F.sum("bet_amount").cast("double"), F.count("*")
    )
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    got.explain()
    assert "Expand" not in capsys.readouterr().out


def test_day_measures_equal_plain_distinct_counts(spark, capsys):
    day = dt.datetime(2024, 1, 1)
    rows = [(str(i), None if i % 5 == 0 else i % 4, None if i % 7 == 0 else f"s{i % 9}", day + dt.timedelta(hours=i))
            for i in range(100)]
    tx = spark.createDataFrame(rows, "transaction_id string, player_id int, session_id string, timestamp timestamp")
    tx = tx.select("*", F.to_date("timestamp").alias("date"), *[
        F.lit(1).cast("decimal(18,2)").alias(c) for c in ("bet_amount", "win_amount", "net_result")])
    out = daily.platform_summary(tx).select("date", "active_players", "total_sessions", "total_bets")
    want = tx.groupBy("date").agg(F.count_distinct("player_id"), F.count_distinct("session_id"), F.count("*"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
    out.explain()
    assert "Expand" not in capsys.readouterr().out


def test_radix_reads_its_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.range(1000).select((F.col("id") % 10).alias("g"), "id").mapInArrow(counted, "g long, id long")
    out = radix.radix_quantiles(df, "id", {"p50": 0.5}, by=["g"]).collect()
    assert len(out) == 10 and read.value == 1000


def test_bronze_copy_is_written_by_many_tasks(spark, star, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "work_folder", lambda _: str(tmp_path))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        report = {r["table"]: r["rows"] for r in catalog.QUERIES["bronze_load_report"](spark, star).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert report == {"bronze": 600, "silver": 600, "rejects": 0, "skipped_files": 1}
    assert len(list((tmp_path / "tx/transactions_month=copy").glob("part-*"))) > 1
