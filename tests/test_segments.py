"""Rule segments, clusters and personas."""

import pytest
from conftest import by
from pyspark.sql import functions as F

from wagerscope.operators import clusters, players, rows, segments
from wagerscope.sources import adapters

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hundred(spark):
    return spark.range(1, 101).select(
        F.col("id").alias("player_id"),
        F.col("id").cast("double").alias("avg_bet_amount"),
        F.col("id").cast("double").alias("total_wagered"),
    )


def test_thresholds_nearest_rank_and_interpolated(hundred):
    approx = segments.segment_thresholds(hundred).first()
    exact = segments.segment_thresholds(hundred, exact=True).first()
    assert (approx.whale_bet_threshold, approx.regular_wager_threshold) == (99.0, 60.0)
    assert exact.whale_bet_threshold == pytest.approx(99.01)
    assert exact.regular_wager_threshold == pytest.approx(60.4)


def test_segments_need_both_measures(spark, hundred):
    sizes = {
        r.player_segment: r.n
        for r in segments.assign_segments(hundred)
        .groupBy("player_segment").agg(F.count("*").alias("n")).collect()
    }
    assert sizes == {"Whale": 2, "VIP": 4, "High": 10, "Regular": 25, "Casual": 59}
    lucky = hundred.withColumn(
        "total_wagered", F.when(F.col("player_id") == 100, 1.0).otherwise(F.col("total_wagered"))
    )
    assert by(segments.assign_segments(lucky), "player_id")[100]["player_segment"] == "Casual"


def test_shares_sum_to_hundred(spark):
    tagged = segments.assign_segments(segments.light_features(adapters.ledger(spark, SF), None))
    total = segments.revenue_concentration(tagged).agg(F.sum("pct_players"), F.sum("pct_revenue")).first()
    assert total[0] == pytest.approx(100) and total[1] == pytest.approx(100)


def test_persona_limits_are_inclusive(spark):
    # Four cluster means whose z-scores are known: 0, 0, 0 and the top.
    df = spark.createDataFrame(
        [("a", 1.0, 1.0, 9.0), ("b", 1.0, 9.0, 1.0), ("c", 1.0, 1.0, 1.0), ("d", 9.0, 1.0, 9.0)],
        "cluster string, total_wagered double, avg_bet_amount double, active_days double",
    )
    got = {r.cluster: r.label for r in clusters.persona_labels(df).collect()}
    assert got == {
        "a": clusters.GRINDER, "b": clusters.RISK_TAKER, "c": clusters.REGULAR, "d": clusters.VIP_WHALE
    }


def test_persona_without_spread_falls_to_the_last_label(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1.0, 1.0), ("b", 1.0, 1.0, 1.0)],
        "cluster string, total_wagered double, avg_bet_amount double, active_days double",
    )
    assert {r.label for r in clusters.persona_labels(df).collect()} == {clusters.LOW_VALUE}


def test_scaling_and_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = clusters.standard_scale(df, ["a", "b"]).select("a_z", "b_z").collect()
    assert sorted(tuple(r) for r in got) == [(-1.0, 0.0), (1.0, 0.0)]


@pytest.fixture(scope="module")
def features(spark):
    tx = adapters.bets(spark, SF, sequence=True)
    return rows.minimum_activity(players.summary_features(tx)).cache()


def test_kmeans_names_follow_the_mean_bet(features):
    out = clusters.kmeans_segments(features, k=3).cache()
    assert out.count() == features.count()
    means = {
        r.player_segment: r.m
        for r in out.groupBy("player_segment").agg(F.avg("avg_bet_amount").alias("m")).collect()
    }
    assert means["Whale"] > means["VIP"] > means["High"]
    labelled = clusters.players_clustered(out.drop("player_segment"))
    assert labelled.count() == features.count()


def test_alternative_clusterings_cover_all_players(features):
    out = clusters.alternative_clusterings(features, k=3).cache()
    assert out.count() == features.count()
    assert out.select("cluster_hierarchical").distinct().count() == 3
    assert out.select("cluster_kmeans").distinct().count() == 3


def test_mixture_starts_with_one_task_per_executor(features, monkeypatch):
    class Recorded(clusters.GaussianMixture):
        def fit(self, df):
            fits.append((df.rdd.getNumPartitions(), self.getMaxIter()))
            return super().fit(df)

    fits = []
    monkeypatch.setattr(clusters, "GaussianMixture", Recorded)
    clusters.alternative_clusterings(features.repartition(4), k=3).count()
    assert fits[0] == (1, 1) and len(fits) == 2  # local mode has one executor


def test_principal_components_explain_less_than_all(features):
    scores, explained = clusters.principal_components(features, clusters.VALUE_FEATURES)
    assert scores.count() == features.count()
    shares = [r.explained_variance_ratio for r in explained.collect()]
    assert shares[0] >= shares[1] > 0 and sum(shares) <= 1


def test_correlation_matrix_agrees_with_pairs(features):
    cols = clusters.VALUE_FEATURES[:4]
    matrix = by(clusters.correlation_matrix(features, cols), "feature")
    for r in clusters.correlation_pairs(features, cols).collect():
        assert matrix[r.feature_a][r.feature_b] == pytest.approx(r.correlation)
