"""The recurring jobs, composed from operators and written as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wagerscope.operators import clusters, daily, dashboards, players, rows, segments
from wagerscope.sources import files, tables


def load_bronze(spark: SparkSession, folder: str, schema_name: str) -> None:
    """Full reload of games and bets from files into ``schema_name``.

    Files left out and rows that the typed load refuses get tables of their own.
    Writing in overwrite mode replaces a truncate and keeps a rerun harmless.
    """
    tables.create_namespace(spark, schema_name)
    games = files.read_games(spark, f"{folder}/games_metadata.csv")
    tables.replace_table(games, f"{schema_name}.games_bronze")
    bronze = files.read_bronze(spark, folder)
    tables.replace_table(bronze, f"{schema_name}.transactions_bronze")
    loaded = tables.read_table(spark, f"{schema_name}.transactions_bronze")
    tables.replace_table(files.rejects(loaded), f"{schema_name}.transactions_rejects")
    skipped = files.skipped_files(spark, folder)
    tables.replace_table(skipped, f"{schema_name}.transactions_skipped_files")


def daily_feature_table(spark: SparkSession, schema_name: str) -> None:
    """Bronze to the daily feature table."""
    tx = files.silver(tables.read_table(spark, f"{schema_name}.transactions_bronze"))
    games = tables.read_table(spark, f"{schema_name}.games_bronze")
    tables.replace_table(
        daily.daily_features(tx, games), f"{schema_name}.daily_aggregations_features"
    )


def training_table(spark: SparkSession, schema_name: str, as_of=None) -> None:
    """Bronze to one row of features per player."""
    tx = files.silver(tables.read_table(spark, f"{schema_name}.transactions_bronze"))
    tables.replace_table(
        players.training_features(tx, as_of), f"{schema_name}.segmentation_training_data"
    )


def persona_table(spark: SparkSession, schema_name: str, k: int = 4) -> None:
    """Training table to ``players_clustered``, which persona dashboards read.

    The training table is read back instead of recomputed for every fit.
    """
    features = tables.read_table(spark, f"{schema_name}.segmentation_training_data")
    grouped = clusters.kmeans_segments(
        features, k=k, cols=clusters.numeric_columns(features)
    ).drop("player_segment")
    labelled = clusters.players_clustered(grouped)
    tables.replace_table(labelled, f"{schema_name}.players_clustered")


def segment_table(tx: DataFrame, name: str, as_of=None) -> None:
    """Weekly refresh of the rule segments."""
    tables.replace_table(segments.player_segments(tx, as_of=as_of), name)


def segmentation_report(tx: DataFrame, folder: str) -> None:
    """Features, segments and daily metrics of a period as csv."""
    features = rows.minimum_activity(players.summary_features(tx))
    tagged = segments.assign_segments(features, exact=True)
    files.write_csv(tagged.select("player_id", "player_segment"), f"{folder}/player_segments")
    files.write_csv(tagged, f"{folder}/player_features")
    by_day = dashboards.daily_by_segment(
        tx, tagged, lookback_days=None, ggr_level="segment_day"
    )
    files.write_csv(by_day, f"{folder}/daily_metrics")
