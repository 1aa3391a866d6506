"""Files, tables and the incremental ingest."""

import pytest
from conftest import by
from pyspark.sql import functions as F

from wagerscope.plans import refresh
from wagerscope.sources import adapters, files, tables
from wagerscope.streaming import ingest

SF = "/root/testdata/sf0.001"
HEADER = (
    "transaction_id,player_id,game_id,timestamp,bet_amount,win_amount,net_result,session_id,"
    "session_balance,consecutive_losses,consecutive_wins,hour,day_of_week,day_of_month,month,"
    "is_weekend,is_peak_hour,is_payday,date"
)


def _line(tid, bet="10.0", day="2024-01-01"):
    return f"{tid},P1,G001,{day} 10:00:00,{bet},0,-10.0,S1,-10.0,1,0,10,0,1,1,0,0,1,{day}"


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "transactions_2024-01.csv").write_text("\n".join([HEADER, _line("T1"), _line("T2", "oops")]) + "\n")
    (tmp_path / "transactions_2024-02.csv").write_text("\n".join([HEADER, _line("T3", day="2024-02-01")]) + "\n")
    (tmp_path / "notes.csv").write_text("a\n1\n")
    (tmp_path / "games_metadata.csv").write_text(
        ",game_id,type,rtp,volatility,min_bet,max_bet,hit_frequency,max_multiplier,bonus_frequency,visual_engagement\n"
        "SLOT_FORTUNE,G001,slot,0.96,high,0.2,500,0.25,5000.0,0.008,0.85\n"
    )
    return tmp_path


def test_bronze_reads_only_matching_files(spark, folder):
    bronze = files.read_bronze(spark, str(folder))
    assert bronze.count() == 3
    assert {r[0].rsplit("/", 1)[1] for r in bronze.select("source_file").distinct().collect()} == {
        "transactions_2024-01.csv", "transactions_2024-02.csv"
    }
    assert files.discover(spark, str(folder)).count() == 2


def test_files_with_other_columns_are_skipped_or_fail(spark, folder):
    (folder / "transactions_0.csv").write_text("player_id,transaction_id\nP1,T9\n")
    assert files.read_bronze(spark, str(folder)).count() == 3
    strict = files.read_bronze(spark, str(folder), skip_bad_files=False)
    with pytest.raises(Exception, match="header"):
        strict.collect()


def test_bad_file_in_many_splits_loads_none_of_its_rows(spark, folder):
    swapped = ["player_id", "transaction_id", *HEADER.split(",")[2:]]
    lines = [_line(f"X{i}") for i in range(200)]
    (folder / "transactions_bad.csv").write_text("\n".join([",".join(swapped), *lines]) + "\n")
    (folder / "transactions_good.csv").write_text("\n".join(["", HEADER, *lines]) + "\n")
    (folder / "transactions_empty.csv").write_text("")
    sizes = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for key in sizes:
        spark.conf.set(key, "1000")
    try:
        bronze = files.read_bronze(spark, str(folder))
        assert bronze.rdd.getNumPartitions() > 10
        got = bronze.groupBy("source_file").count().collect()
    finally:
        for key in sizes:
            spark.conf.unset(key)
    assert {r.source_file.rsplit("/", 1)[1]: r["count"] for r in got} == {
        "transactions_2024-01.csv": 2, "transactions_2024-02.csv": 1, "transactions_good.csv": 200
    }
    bad = files.skipped_files(spark, str(folder)).first()
    assert bad.path.endswith("/transactions_bad.csv") and bad.reason.startswith("header: player_id,")


def test_games_are_read_by_name(spark, tmp_path):
    (tmp_path / "g.csv").write_text(
        "rtp,,game_id,type,volatility,min_bet,max_bet,hit_frequency,max_multiplier,bonus_frequency,visual_engagement\n"
        "0.96,SLOT_FORTUNE,G001,slot,high,0.2,500,0.25,5000.0,0.008,0.85\n"
    )
    row = files.read_games(spark, str(tmp_path / "g.csv")).first()
    assert (row.game_name, row.game_id, row.rtp, row.max_bet) == ("SLOT_FORTUNE", "G001", 0.96, 500)
    (tmp_path / "h.csv").write_text("game_id,type\nG001,slot\n")
    with pytest.raises(ValueError, match="lacks"):
        files.read_games(spark, str(tmp_path / "h.csv"))


def test_load_job_keeps_rejects_and_skipped_files(spark, folder):
    (folder / "transactions_0.csv").write_text("player_id,transaction_id\nP1,T9\n")
    refresh.load_bronze(spark, str(folder), "ws_load")
    counts = [spark.table(f"ws_load.transactions_{t}").count() for t in ("bronze", "rejects", "skipped_files")]
    assert counts == [3, 1, 1]


def test_silver_and_rejects_split_the_rows(spark, folder):
    bronze = files.read_bronze(spark, str(folder))
    good, bad = files.silver(bronze), files.rejects(bronze)
    assert sorted(r.transaction_id for r in good.collect()) == ["T1", "T3"]
    assert [r.transaction_id for r in bad.collect()] == ["T2"]
    assert dict(good.dtypes)["bet_amount"] == "decimal(18,2)"
    assert dict(good.dtypes)["date"] == "date"


def test_months_skip_missing_and_fail_on_none(spark, folder, capsys):
    tx = files.read_months(spark, str(folder), ["2024-01", "2024-07"])
    assert tx.count() == 2 and "2024-07" in capsys.readouterr().out
    with pytest.raises(ValueError):
        files.read_months(spark, str(folder), ["2023-01"])


def test_games_unnamed_column(spark, folder):
    row = files.read_games(spark, str(folder / "games_metadata.csv")).first()
    assert (row.game_name, row.rtp, row.max_bet) == ("SLOT_FORTUNE", 0.96, 500)


def test_cast_times_ignores_missing_columns(spark):
    df = spark.createDataFrame([("2024-01-01", 1)], "date string, x int")
    assert dict(files.cast_times(df).dtypes) == {"date": "timestamp", "x": "int"}


def test_incremental_ingest_reads_each_file_once(spark, folder, tmp_path):
    out, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")
    ingest.append_new_files(spark, str(folder), out, offsets)
    (folder / "transactions_2024-03.csv").write_text("\n".join([HEADER, _line("T4")]) + "\n")
    (folder / "transactions_0.csv").write_text("player_id,transaction_id\nP1,T9\n")
    ingest.append_new_files(spark, str(folder), out, offsets)
    got = [r[0] for r in spark.read.parquet(out).select("transaction_id").collect()]
    assert sorted(got) == ["T1", "T2", "T3", "T4"]
    assert spark.read.parquet(f"{out}_skipped").count() == 1


def test_month_export_round_trip(spark, tmp_path):
    tx = adapters.bets(spark, SF, sequence=True)
    files.write_months(tx, str(tmp_path / "tx"))
    back = files.silver(files.read_bronze(spark, str(tmp_path / "tx"), prefix="part"))
    assert back.count() == tx.count()
    want = tx.agg(F.sum("net_result"), F.max("timestamp")).first()
    assert tuple(back.agg(F.sum("net_result"), F.max("timestamp")).first()) == tuple(want)


def test_tables_replace_append_truncate(spark):
    tables.create_namespace(spark, "ws_test")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    tables.replace_table(df, "ws_test.t", partition_by=("k",), cluster_by="id")
    tables.replace_table(df.where("id = 1"), "ws_test.t")
    assert tables.read_table(spark, "ws_test.t").count() == 1
    tables.append_table(df, "ws_test.t")
    assert spark.table("ws_test.t").count() == 3
    tables.empty_table(spark, "ws_test.t")
    tables.empty_table(spark, "ws_test.none")
    assert spark.table("ws_test.t").count() == 0
    tables.drop_and_create(df, "ws_test.t")
    assert tables.create_view(spark.table("ws_test.t"), "ws_view").count() == 2


def test_read_daily_is_none_without_files(spark, tmp_path):
    assert files.read_daily(spark, str(tmp_path / "missing")) is None


def test_statistics_row(spark, tmp_path, make_tx):
    tx = make_tx([("a", "s", "2024-01-01 10:00:00", "G001", 10, 0)])
    flagged = spark.createDataFrame([("a", True), ("b", False)], "player_id string, is_churned boolean")
    seg = spark.createDataFrame([("a", "VIP")], "player_id string, player_segment string")
    stats = files.run_statistics(tx, flagged, seg)
    files.write_statistics(stats, str(tmp_path / "stats"))
    row = spark.read.json(str(tmp_path / "stats")).first()
    assert (row.total_players, row.total_churned, row.churn_rate, row.gross_gaming_revenue) == (2, 1, 0.5, 10.0)
    assert row.churn_by_segment.VIP == 1


def test_recurring_jobs_end_to_end(spark, tmp_path):
    tx = adapters.bets(spark, SF, sequence=True)
    files.write_months(tx, str(tmp_path / "in"))
    # Month folders hold part files; the load looks for files by prefix.
    bronze = files.read_bronze(spark, str(tmp_path / "in"), prefix="part")
    tables.create_namespace(spark, "ws_jobs")
    tables.replace_table(bronze, "ws_jobs.transactions_bronze")
    tables.replace_table(adapters.games(spark), "ws_jobs.games_bronze")
    refresh.daily_feature_table(spark, "ws_jobs")
    assert spark.table("ws_jobs.daily_aggregations_features").count() == 120
    refresh.training_table(spark, "ws_jobs")
    refresh.persona_table(spark, "ws_jobs", k=3)
    trained = spark.table("ws_jobs.segmentation_training_data").count()
    assert spark.table("ws_jobs.players_clustered").count() == trained > 0
    refresh.segmentation_report(tx, str(tmp_path / "report"))
    tagged = spark.read.option("header", True).csv(str(tmp_path / "report" / "player_segments"))
    assert tagged.count() == trained
    assert by(tagged.groupBy("player_segment").count(), "player_segment")
