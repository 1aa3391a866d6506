"""Clustered segments, personas and feature exploration.

Fits run on ``pyspark.ml``; what reaches the driver is bounded by the number of
features and clusters.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark import StorageLevel
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerscope.functions.metrics import ratio
from wagerscope.operators.rows import fill_numeric
from wagerscope.schema import SEGMENTS

SEED = 42

# The features the value segments are clustered on.
VALUE_FEATURES = (
    "avg_bet_amount",
    "total_wagered",
    "total_net_loss",
    "sessions_per_day",
    "bets_per_session",
    "bet_cv",
    "win_rate",
    "max_consecutive_losses",
)

PROFILE_METRICS = ("total_wagered", "total_net_loss", "avg_bet_amount", "active_days")

# Persona labels.
VIP_WHALE = "🌟 VIP Whale"
HIGH_ROLLER = "💰 High Roller"
GRINDER = "⚙️ The Grinder"
RISK_TAKER = "🎲 Risk Taker"
REGULAR = "👤 Regular"
TOURIST = "🏖️ Tourist / Casual"
LOW_VALUE = "📉 Low Value Active"


def numeric_columns(df: DataFrame, skip: Sequence[str] = ("player_id",)) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def standard_scale(
    df: DataFrame, cols: Sequence[str], center: bool = True, suffix: str = "_z"
) -> DataFrame:
    """M5: z-scores with the population spread; a constant column becomes 0."""
    cols = list(cols)
    clean = fill_numeric(df, 0, cols)
    stats = clean.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"{c}_mean") for c in cols],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"{c}_sd") for c in cols],
    )
    known = clean.withColumn("_stats", stats.select(F.struct("*")).scalar())

    def z(c: str) -> Column:
        x = F.col(c).cast("double")
        if center:
            x = x - F.col("_stats")[f"{c}_mean"]
        return ratio(x, F.col("_stats")[f"{c}_sd"], 0)

    return known.withColumns({f"{c}{suffix}": z(c) for c in cols}).drop("_stats")


def _vectors(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def correlation_pairs(features: DataFrame, cols: Sequence[str] = VALUE_FEATURES) -> DataFrame:
    """M6: Pearson correlation of each pair of columns once (lower triangle)."""
    clean = fill_numeric(features, 0, cols)

    def one(a: str, b: str) -> Column:
        r = F.corr(F.col(a).cast("double"), F.col(b).cast("double"))
        return F.struct(
            F.lit(a).alias("feature_a"),
            F.lit(b).alias("feature_b"),
            F.when(~F.isnan(r), r).alias("correlation"),
        )

    pairs = F.array(*[one(a, b) for a, b in combinations(cols, 2)])
    return clean.agg(pairs.alias("pairs")).select(F.inline("pairs"))


def correlation_matrix(features: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """M6 over all numeric columns: one row per feature, one column per feature."""
    cols = list(cols or numeric_columns(features))
    vectors = _vectors(fill_numeric(features, 0, cols), cols, "v").select("v")
    matrix = Correlation.corr(vectors, "v").head()[0].toArray()
    rows = [(name, *map(float, matrix[i])) for i, name in enumerate(cols)]
    kind = T.StructType(
        [T.StructField("feature", T.StringType())]
        + [T.StructField(c, T.DoubleType()) for c in cols]
    )
    return features.sparkSession.createDataFrame(rows, kind)


def principal_components(
    features: DataFrame, cols: Sequence[str] | None = None, key: str = "player_id"
) -> tuple[DataFrame, DataFrame]:
    """M7: scores on two components, and the variance each explains."""
    cols = list(cols or numeric_columns(features))
    scaled = _vectors(standard_scale(features, cols), [f"{c}_z" for c in cols], "_z").select(
        key, "_z"
    )
    model = PCA(k=2, inputCol="_z", outputCol="_pc").fit(scaled)
    scores = model.transform(scaled).withColumn("_pc", vector_to_array("_pc"))
    explained = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance.toArray())]
    return (
        scores.select(key, F.get("_pc", F.lit(0)).alias("pc1"), F.get("_pc", F.lit(1)).alias("pc2")),
        features.sparkSession.createDataFrame(
            explained, "component int, explained_variance_ratio double"
        ),
    )


def _best_kmeans(vectors: DataFrame, col: str, out: str, k: int, seed: int, n_init: int):
    models = [
        KMeans(k=k, seed=seed + i, featuresCol=col, predictionCol=out).fit(vectors)
        for i in range(n_init)
    ]
    return min(models, key=lambda m: m.summary.trainingCost)


def kmeans_segments(
    features: DataFrame,
    k: int = 5,
    cols: Sequence[str] = VALUE_FEATURES,
    names: Sequence[str] = SEGMENTS,
    seed: int = SEED,
    n_init: int = 1,
) -> DataFrame:
    """M4: K-Means on scaled features; clusters are named by falling mean bet.

    ``n_init`` repeats the fit with other seeds and keeps the tightest one.
    """
    scaled = _vectors(standard_scale(features, cols), [f"{c}_z" for c in cols], "_z")
    vectors = scaled.select("_z").persist(StorageLevel.MEMORY_AND_DISK)
    model = _best_kmeans(vectors, "_z", "cluster", k, seed, n_init)
    vectors.unpersist()
    placed = model.transform(scaled).drop("_z", *[f"{c}_z" for c in cols])
    by_bet = Window.orderBy(F.desc("mean_bet"), "cluster")
    ranked = placed.groupBy("cluster").agg(F.avg("avg_bet_amount").alias("mean_bet"))
    named = ranked.select(
        "cluster",
        F.get(F.array(*[F.lit(n) for n in names]), F.row_number().over(by_bet) - 1).alias(
            "player_segment"
        ),
    )
    return placed.join(named, "cluster")


def _start_lapack(spark: SparkSession) -> None:
    """One small eigendecomposition alone in each executor, before a fit runs several at once there.

    The Java LAPACK finds its machine constants at the first call, unguarded: a task
    that calls it meanwhile reads zeros and may scale its matrix for ever.  Cached
    rows, a partition per executor, keep it to one task in each.
    """
    executors = max(1, spark.sparkContext._jsc.sc().getExecutorMemoryStatus().size() - 1)
    rows = spark.range(0, 8 * executors, 1, executors).select(
        F.array(F.col("id") % 3, F.col("id") % 5).cast("array<double>").alias("v")
    )
    rows = rows.select(array_to_vector("v").alias("v")).persist(StorageLevel.MEMORY_AND_DISK)
    rows.count()
    GaussianMixture(k=2, seed=SEED, featuresCol="v", maxIter=1).fit(rows)
    rows.unpersist()


def alternative_clusterings(
    features: DataFrame,
    k: int = 4,
    cols: Sequence[str] | None = None,
    key: str = "player_id",
    seed: int = SEED,
    n_init: int = 1,
) -> DataFrame:
    """M8: K-Means, bisecting K-Means and a Gaussian mixture side by side.

    Bisecting K-Means stands in for bottom-up clustering, which needs all pairs
    of players.  It gets uncentred features: it splits a cluster by shifting
    its centre in proportion to the centre's length.
    """
    cols = list(cols or numeric_columns(features))
    centred = standard_scale(features, cols)
    both = standard_scale(centred, cols, center=False, suffix="_s")
    data = _vectors(both, [f"{c}_z" for c in cols], "_z")
    data = _vectors(data, [f"{c}_s" for c in cols], "_s").select(key, "_z", "_s")
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    _start_lapack(features.sparkSession)
    models = [
        _best_kmeans(data, "_z", "cluster_kmeans", k, seed, n_init),
        BisectingKMeans(
            k=k, seed=seed, featuresCol="_s", predictionCol="cluster_hierarchical"
        ).fit(data),
        GaussianMixture(
            k=k,
            seed=seed,
            featuresCol="_z",
            predictionCol="cluster_mixture",
            probabilityCol="_p",
        ).fit(data),
    ]
    out = data
    for model in models:
        out = model.transform(out)
    return out.select(key, "cluster_kmeans", "cluster_hierarchical", "cluster_mixture")


def cluster_profile(
    features: DataFrame, cluster: str = "cluster", metrics: Sequence[str] = PROFILE_METRICS
) -> DataFrame:
    """Means per cluster and their z-scores across clusters (sample spread)."""
    present = [m for m in metrics if m in features.columns]
    means = features.groupBy(cluster).agg(*[F.avg(F.col(m).cast("double")).alias(m) for m in present])
    every = Window.partitionBy()
    return means.select(
        "*",
        *[
            ratio(F.col(m) - F.avg(m).over(every), F.stddev_samp(m).over(every)).alias(f"{m}_z")
            for m in present
        ],
    )


def persona_labels(features: DataFrame, cluster: str = "cluster") -> DataFrame:
    """M9: a readable label per cluster from the z-scores of its profile.

    A z-score that does not exist (all clusters alike) meets no condition.
    """
    wager, bet, days = (
        F.col(f"{m}_z") for m in ("total_wagered", "avg_bet_amount", "active_days")
    )
    # Limits between the personas.
    top = F.when(days > 0.5, VIP_WHALE).otherwise(HIGH_ROLLER)
    middle = (
        F.when((days > 0.5) & (bet < 0), GRINDER)
        .when(bet > 0.5, RISK_TAKER)
        .otherwise(REGULAR)
    )
    low = F.when(days < -0.5, TOURIST).otherwise(LOW_VALUE)
    return cluster_profile(features, cluster).select(
        cluster,
        F.when(wager > 1.0, top)
        .when(wager.between(-0.5, 1.0), middle)
        .otherwise(low)
        .alias("label"),
    )


def players_clustered(features: DataFrame, cluster: str = "cluster") -> DataFrame:
    """M9: player, cluster and label; the table persona dashboards join to."""
    return features.join(persona_labels(features, cluster), cluster).select(
        "player_id", cluster, "label"
    )
