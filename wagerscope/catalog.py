"""The registered queries: operators applied to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerscope import schema
from wagerscope.functions import calendar, carry, radix, scans
from wagerscope.functions.metrics import ggr, mean, ratio
from wagerscope.operators import clusters, daily, dashboards, lifecycle, players, rows, segments
from wagerscope.session import work_folder
from wagerscope.sources import adapters, dated, files, tables
from wagerscope.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to ``digits`` places and money as doubles, so results compare across engines."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        if isinstance(f.dataType, (T.DoubleType, T.DecimalType)):
            c = (F.round(c, digits) + 0.0).alias(f.name)  # + 0.0 turns -0.0 into 0.0
        out.append(c)
    return df.select(*out)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(fn(spark, sf_dir))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return daily.daily_game_aggregate(adapters.bets(spark, d), adapters.games(spark))


def _bet_segments(spark: SparkSession, d: str) -> DataFrame:
    return segments.player_segments(adapters.bets(spark, d))


def _ledger_segments(spark: SparkSession, d: str) -> DataFrame:
    return segments.player_segments(adapters.ledger(spark, d), lookback_days=None)


def _personas(tx: DataFrame, lookback_days: int | None) -> DataFrame:
    """Personas over the rule segments, so labels do not depend on a random fit."""
    features = segments.assign_segments(segments.light_features(tx, lookback_days))
    return clusters.players_clustered(features, "player_segment")


def _ledger_personas(spark: SparkSession, d: str) -> DataFrame:
    return _personas(adapters.ledger(spark, d), None)


def _features(spark: SparkSession, d: str) -> DataFrame:
    """Player features, written once so a fit and its result read the same table.

    So are the bets: every part of the features would cut sessions and sequence
    them again.
    """
    tx = stored(adapters.bets(spark, d, sequence=True))
    return stored(rows.minimum_activity(players.summary_features(tx)))


def stored(df: DataFrame) -> DataFrame:
    path = f"{work_folder(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- rows --------------------------------------------------------------------------


@query
def calendar_columns(spark, d):
    return adapters.bets(spark, d).select(
        "transaction_id", "hour", "day_of_week", "day_of_month", "month",
        "is_weekend", "is_peak_hour", "is_payday", "date",
    )


@query
def ledger_calendar_paydays(spark, d):
    tx = adapters.ledger(spark, d)
    out = rows.calendar_columns(tx, peak_hours=(18, 23), paydays=(1, 2, 3, 15, 16, 17))
    return out.groupBy("is_payday", "is_weekend", "is_peak_hour").agg(
        F.count("*").alias("n"), F.sum("net_result").alias("net")
    )


@query
def temporal_features(spark, d):
    days = adapters.ledger(spark, d).groupBy("date").agg(F.count("*").alias("bets"))
    return rows.temporal_features(days)


@query
def net_result(spark, d):
    return adapters.bets(spark, d).select(
        "transaction_id", "bet_amount", "win_amount", "net_result", "session_id"
    )


@query
def running_balance(spark, d):
    tx = rows.running_balance(adapters.bets(spark, d))
    return tx.select("transaction_id", "session_id", "session_balance")


@query
def ledger_running_balance(spark, d):
    tx = rows.running_balance(adapters.ledger(spark, d), slice_seconds=30 * 86_400)
    return tx.select("transaction_id", "session_id", "session_balance")


@query
def streak_lengths(spark, d):
    tx = rows.streak_lengths(adapters.bets(spark, d))
    return tx.select("transaction_id", "consecutive_losses", "consecutive_wins")


@query
def player_streak_lengths(spark, d):
    """Streaks across a player's sessions: long runs that span many slices."""
    hit = F.col("win_amount") > 0
    tx = scans.ordered_state(
        adapters.bets(spark, d),
        runs=(hit, "consecutive_losses", "consecutive_wins"),
        keys=["player_id"],
    )
    return tx.select("transaction_id", "consecutive_losses", "consecutive_wins")


@query
def previous_bets(spark, d):
    tx = scans.ordered_state(
        adapters.bets(spark, d), previous={"bet_amount": "prev_bet", "net_result": "prev_net"}
    )
    return tx.select("transaction_id", "prev_bet", "prev_net")


@query
def win_multipliers(spark, d):
    return rows.win_multipliers(adapters.bets(spark, d)).select("transaction_id", "multiplier")


@query
def winsorised_bets(spark, d):
    tx = rows.winsorise(adapters.bets(spark, d), "bet_amount", 0.01, 0.99)
    return tx.select("transaction_id", "bet_amount_clipped")


@query
def exact_bet_quantiles(spark, d):
    return scans.exact_quantiles(
        adapters.ledger(spark, d), "bet_amount", {"p01": 0.01, "p50": 0.5, "p99": 0.99},
        by=["game_id"],
    )


@query
def week_starts(spark, d):
    tx = rows.with_week_start(adapters.ledger(spark, d))
    return tx.groupBy("week_start").agg(F.count("*").alias("bets"))


@query
def month_abbreviations(spark, d):
    tx = adapters.ledger(spark, d)
    return tx.groupBy("month").agg(F.count("*").alias("bets")).select(
        "month", calendar.month_abbreviation("month").alias("month_abbr"), "bets"
    )


@query
def cohort_indexes(spark, d):
    tx = adapters.ledger(spark, d).join(
        lifecycle.player_cohorts(adapters.ledger(spark, d)), "player_id"
    )
    exact = rows.with_cohort_index(tx)
    parity = rows.with_cohort_index(
        exact.withColumnRenamed("months_since_acquisition", "calendar_index"), mode="days_30_44"
    )
    return parity.groupBy("calendar_index", "months_since_acquisition").agg(
        F.count("*").alias("bets")
    )


@query
def game_names(spark, d):
    tx = rows.with_game_names(adapters.bets(spark, d), adapters.games(spark))
    return tx.groupBy("game_id", "game_name").agg(F.count("*").alias("bets"))


@query
def game_types(spark, d):
    tx = rows.with_game_type(adapters.bets(spark, d), adapters.games(spark))
    return tx.groupBy("game_id", "type").agg(F.count("*").alias("bets"))


@query
def look_back_rows(spark, d):
    tx = calendar.look_back(adapters.ledger(spark, d), 90)
    return tx.groupBy("date").agg(F.count("*").alias("bets"))


@query
def minimum_activity(spark, d):
    tx = adapters.bets(spark, d, sequence=True)
    return rows.minimum_activity(players.player_base(tx)).select("player_id", "total_bets", "active_days")


@query
def date_range(spark, d):
    tx = rows.date_range(adapters.ledger(spark, d), "1996-03-01", "1996-03-31")
    return tx.groupBy("date").agg(F.count("*").alias("bets"), mean("bet_amount").alias("avg_bet"))


@query
def string_predicates(spark, d):
    tx = adapters.bets(spark, d)
    return tx.agg(
        F.count_if(rows.game_prefix("G001")).alias("slots"),
        F.count_if(rows.game_prefix("G002")).alias("tables"),
        F.count_if(rows.label_contains("00", "game_id")).alias("known"),
    )


@query
def stable_sample(spark, d):
    return rows.stable_sample(adapters.bets(spark, d), "transaction_id", 10).select(
        "transaction_id", "bet_amount"
    )


@query
def random_sample(spark, d):
    return rows.random_sample(adapters.bets(spark, d)).select("transaction_id", "bet_amount")


@query
def filled_features(spark, d):
    summary = players.player_summary(adapters.bets(spark, d))
    return rows.fill_numeric(summary.select("player_id", "bet_volatility", "avg_daily_value"))


@query
def ggr_definitions(spark, d):
    tx = adapters.bets(spark, d)
    modes = ["house", "losses", "absolute", "player", "house_or_zero"]
    return tx.groupBy("game_id").agg(*[ggr("net_result", m).alias(f"ggr_{m}") for m in modes])


# --- daily -------------------------------------------------------------------------


@query
def first_appearance(spark, d):
    return daily.first_appearance(adapters.bets(spark, d))


@query
def platform_growth(spark, d):
    return daily.platform_growth(adapters.bets(spark, d))


@query
def ledger_platform_growth(spark, d):
    return daily.platform_growth(adapters.ledger(spark, d))


@query
def daily_game_aggregate(spark, d):
    return _daily(spark, d)


@query
def daily_game_aggregate_carried(spark, d):
    return daily.daily_game_aggregate(
        adapters.bets(spark, d), adapters.games(spark), carry_forward=True
    ).select("date", "game_id", "cumulative_player_base")


def _with_keys(df: DataFrame, *cols: str) -> DataFrame:
    return df.select("date", "game_id", *cols)


@query
def lag_features(spark, d):
    out = daily.lag_features(_daily(spark, d))
    return _with_keys(out, *[c for c in out.columns if "_lag" in c])


@query
def moving_averages(spark, d):
    out = daily.moving_averages(_daily(spark, d))
    return _with_keys(out, *[c for c in out.columns if "_ma" in c])


@query
def moving_averages_full_windows(spark, d):
    out = daily.moving_averages(_daily(spark, d), min_periods=7)
    return _with_keys(out, "ggr_ma7", "revenue_ma7")


@query
def moving_deviations(spark, d):
    out = daily.moving_deviations(_daily(spark, d))
    return _with_keys(out, "ggr_std7", "ggr_std30", "revenue_std7")


@query
def moving_sums(spark, d):
    return _with_keys(daily.moving_sums(_daily(spark, d)), "ggr_sum7", "revenue_sum7")


@query
def moving_range(spark, d):
    return _with_keys(daily.moving_range(_daily(spark, d)), "ggr_min7", "ggr_max7", "ggr_range7")


@query
def growth_rates(spark, d):
    out = daily.growth_rates(daily.lag_features(_daily(spark, d)))
    return _with_keys(out, *[c for c in out.columns if "_growth_" in c])


@query
def interaction_ratios(spark, d):
    out = daily.interaction_ratios(_daily(spark, d))
    return _with_keys(
        out, "ggr_per_player", "revenue_per_player", "bets_per_session", "hold_vs_expected"
    )


@query
def volatility_ratio(spark, d):
    out = daily.volatility_ratio(daily.moving_averages(_daily(spark, d)))
    return _with_keys(out, "ggr_vs_ma7_ratio")


@query
def daily_features(spark, d):
    return daily.daily_features(adapters.bets(spark, d), adapters.games(spark))


@query
def platform_summary(spark, d):
    return daily.platform_summary(adapters.bets(spark, d))


@query
def ledger_platform_summary(spark, d):
    return daily.platform_summary(adapters.ledger(spark, d))


@query
def kpi_strip(spark, d):
    return daily.kpi_strip(_daily(spark, d), "2024-01-05", "2024-01-25")


@query
def daily_ggr_trend(spark, d):
    return daily.daily_ggr_trend(_daily(spark, d))


@query
def wagering_by_game(spark, d):
    return daily.wagering_by_game(_daily(spark, d), adapters.games(spark))


@query
def hold_by_game_and_day(spark, d):
    return daily.hold_by_game_and_day(_daily(spark, d))


@query
def game_comparison(spark, d):
    return daily.game_comparison(_daily(spark, d), adapters.games(spark))


@query
def type_comparison(spark, d):
    return daily.type_comparison(_daily(spark, d))


# --- players -----------------------------------------------------------------------


@query
def player_base(spark, d):
    return players.player_base(adapters.bets(spark, d, sequence=True))


@query
def most_common_times(spark, d):
    return players.most_common_times(adapters.bets(spark, d))


@query
def distinct_rows(spark, d):
    return players.distinct_rows(adapters.ledger(spark, d), "player_id", "game_id", "date")


@query
def session_rollup(spark, d):
    return players.session_rollup(adapters.bets(spark, d, sequence=True))


@query
def session_features(spark, d):
    return players.session_features(adapters.bets(spark, d, sequence=True))


@query
def session_features_peak(spark, d):
    tx = adapters.bets(spark, d, sequence=True)
    return players.session_features(tx, "peak").select(
        "player_id", "worst_session_balance", "best_session_result"
    )


@query
def session_features_closing(spark, d):
    tx = adapters.bets(spark, d, sequence=True)
    return players.session_features(tx, "closing").select(
        "player_id", "worst_session_balance", "best_session_result"
    )


@query
def recency_features(spark, d):
    return players.recency_features(adapters.bets(spark, d))


@query
def ledger_recency_features(spark, d):
    return players.recency_features(adapters.ledger(spark, d))


@query
def bet_escalation(spark, d):
    return players.bet_escalation(adapters.bets(spark, d))


@query
def training_features(spark, d):
    return players.training_features(adapters.bets(spark, d, sequence=True))


@query
def risk_scores(spark, d):
    out = players.training_features(adapters.bets(spark, d, sequence=True))
    return out.groupBy("preliminary_risk_score").agg(F.count("*").alias("players"))


@query
def summary_features(spark, d):
    return players.summary_features(adapters.bets(spark, d, sequence=True))


@query
def player_summary(spark, d):
    return players.player_summary(
        adapters.ledger(spark, d),
        adapters.market_segments(spark, d).withColumnRenamed("player_segment", "segment"),
    )


@query
def player_churn_flags(spark, d):
    tx = adapters.ledger(spark, d)
    return players.with_churn_flag(players.player_summary(tx), tx).select(
        "player_id", "is_churned", "churn_date"
    )


# --- segments ----------------------------------------------------------------------


@query
def light_features(spark, d):
    return segments.light_features(adapters.ledger(spark, d), lookback_days=730, min_bets=10)


@query
def segment_thresholds(spark, d):
    return segments.segment_thresholds(segments.light_features(adapters.bets(spark, d)))


@query
def segment_thresholds_exact(spark, d):
    return segments.segment_thresholds(
        segments.light_features(adapters.ledger(spark, d), None), exact=True
    )


@query
def player_segments(spark, d):
    return _bet_segments(spark, d)


@query
def player_segments_exact(spark, d):
    return segments.player_segments(
        adapters.ledger(spark, d), lookback_days=None, exact=True
    ).select("player_id", "player_segment")


@query
def segment_sizes(spark, d):
    return segments.segment_sizes(_bet_segments(spark, d))


def _segmented_features(spark, d):
    features = segments.light_features(adapters.bets(spark, d))
    return segments.assign_segments(
        features.withColumn("sessions_per_day", ratio("total_sessions", "active_days")),
        exact=True,
    )


@query
def segment_summary(spark, d):
    return segments.segment_summary(_segmented_features(spark, d))


@query
def revenue_concentration(spark, d):
    return segments.revenue_concentration(_segmented_features(spark, d))


# --- clusters ----------------------------------------------------------------------


@query
def standard_scaled(spark, d):
    features = segments.light_features(adapters.ledger(spark, d), None)
    cols = ["avg_bet_amount", "total_wagered", "total_sessions", "active_days"]
    return clusters.standard_scale(features, cols).select("player_id", *[f"{c}_z" for c in cols])


@query
def correlation_pairs(spark, d):
    features = segments.light_features(adapters.ledger(spark, d), None)
    cols = ["avg_bet_amount", "total_wagered", "total_sessions", "active_days", "total_net_loss"]
    return clusters.correlation_pairs(features, cols)


@query
def cluster_profile(spark, d):
    features = segments.assign_segments(segments.light_features(adapters.ledger(spark, d), None))
    return clusters.cluster_profile(features, "player_segment")


@query
def persona_labels(spark, d):
    features = segments.assign_segments(segments.light_features(adapters.ledger(spark, d), None))
    return clusters.persona_labels(features, "player_segment")


@query
def players_clustered(spark, d):
    return _ledger_personas(spark, d)


@query
def correlation_matrix(spark, d):
    return clusters.correlation_matrix(_features(spark, d), clusters.VALUE_FEATURES)


@query
def principal_components(spark, d):
    return clusters.principal_components(_features(spark, d))[0]


@query
def explained_variance(spark, d):
    return clusters.principal_components(_features(spark, d))[1]


@query
def kmeans_segments(spark, d):
    return clusters.kmeans_segments(_features(spark, d)).select(
        "player_id", "cluster", "player_segment"
    )


@query
def alternative_clusterings(spark, d):
    return clusters.alternative_clusterings(_features(spark, d))


@query
def kmeans_personas(spark, d):
    grouped = clusters.kmeans_segments(_features(spark, d), k=4).drop("player_segment")
    return clusters.players_clustered(grouped)


# --- dashboards --------------------------------------------------------------------


@query
def daily_by_segment(spark, d):
    return dashboards.daily_by_segment(adapters.bets(spark, d), _bet_segments(spark, d))


@query
def daily_by_segment_day_result(spark, d):
    return dashboards.daily_by_segment(
        adapters.bets(spark, d), _bet_segments(spark, d), None, ggr_level="segment_day"
    )


@query
def weekly_by_segment(spark, d):
    return dashboards.weekly_by_segment(adapters.ledger(spark, d), _ledger_segments(spark, d))


@query
def weekly_by_segment_week_result(spark, d):
    return dashboards.weekly_by_segment(
        adapters.ledger(spark, d), _ledger_segments(spark, d), None, ggr_level="segment_week"
    )


@query
def segment_snapshot(spark, d):
    return dashboards.segment_snapshot(adapters.ledger(spark, d), _ledger_segments(spark, d))


@query
def risk_indicators(spark, d):
    return dashboards.risk_indicators(
        adapters.bets(spark, d, sequence=True), _bet_segments(spark, d)
    )


@query
def recent_risk_indicators(spark, d):
    return dashboards.risk_indicators(
        adapters.bets(spark, d, sequence=True), _bet_segments(spark, d),
        days=7, streak=3, session_loss=100,
    )


@query
def game_preference(spark, d):
    return dashboards.game_preference(adapters.bets(spark, d), _bet_segments(spark, d))


@query
def total_ggr_by_segment(spark, d):
    by_day = dashboards.daily_by_segment(adapters.bets(spark, d), _bet_segments(spark, d))
    return dashboards.total_ggr_by_segment(by_day)


@query
def monthly_ggr_by_persona(spark, d):
    return dashboards.monthly_ggr_by_persona(
        adapters.ledger(spark, d), _ledger_personas(spark, d)
    )


@query
def arpu_by_persona(spark, d):
    return dashboards.arpu_by_persona(adapters.ledger(spark, d), _ledger_personas(spark, d))


@query
def bet_spread_by_persona(spark, d):
    return dashboards.bet_spread_by_persona(adapters.ledger(spark, d), _ledger_personas(spark, d))


@query
def top_players(spark, d):
    return dashboards.top_players(adapters.ledger(spark, d))


@query
def bet_size_by_streak(spark, d):
    return dashboards.bet_size_by_streak(adapters.bets(spark, d, sequence=True))


@query
def pareto_curve(spark, d):
    return dashboards.pareto_curve(adapters.ledger(spark, d))


@query
def top_share(spark, d):
    return dashboards.top_share(adapters.ledger(spark, d))


@query
def hourly_profile(spark, d):
    return dashboards.hourly_profile(adapters.bets(spark, d))


@query
def weekday_profile(spark, d):
    return dashboards.weekday_profile(adapters.ledger(spark, d))


@query
def weekend_split(spark, d):
    return dashboards.weekend_split(adapters.ledger(spark, d))


@query
def peak_split(spark, d):
    return dashboards.peak_split(adapters.bets(spark, d))


@query
def bet_histogram(spark, d):
    return dashboards.bet_histogram(adapters.bets(spark, d))


@query
def multiplier_histogram(spark, d):
    return dashboards.multiplier_histogram(adapters.bets(spark, d))


@query
def net_histogram(spark, d):
    return dashboards.net_histogram(adapters.ledger(spark, d))


@query
def lognormal_fit(spark, d):
    return dashboards.lognormal_fit(adapters.bets(spark, d))


@query
def lognormal_curve(spark, d):
    return dashboards.lognormal_curve(adapters.bets(spark, d))


@query
def distribution_summary(spark, d):
    return dashboards.distribution_summary(adapters.bets(spark, d))


# --- lifecycle ---------------------------------------------------------------------


@query
def first_activity(spark, d):
    return lifecycle.first_activity(adapters.ledger(spark, d))


@query
def monthly_acquisition(spark, d):
    return lifecycle.monthly_acquisition(
        adapters.ledger(spark, d), slot_prefix="S", table_prefix="PROMO"
    )


@query
def acquisition_by_segment(spark, d):
    return lifecycle.acquisition_by_segment(
        adapters.ledger(spark, d), _ledger_segments(spark, d)
    )


@query
def player_cohorts(spark, d):
    return lifecycle.player_cohorts(adapters.ledger(spark, d))


@query
def cohort_retention(spark, d):
    return lifecycle.cohort_retention(adapters.ledger(spark, d), max_months=None)


@query
def cohort_retention_30_44(spark, d):
    return lifecycle.cohort_retention(adapters.ledger(spark, d), mode="days_30_44")


@query
def cohort_matrix(spark, d):
    return lifecycle.cohort_matrix(adapters.ledger(spark, d))


@query
def retention_by_segment(spark, d):
    return lifecycle.retention_by_segment(adapters.ledger(spark, d), _ledger_segments(spark, d))


@query
def retention_by_persona(spark, d):
    return lifecycle.retention_by_persona(adapters.ledger(spark, d), _ledger_personas(spark, d))


@query
def window_retention(spark, d):
    return lifecycle.window_retention(adapters.ledger(spark, d))


@query
def window_retention_later_days(spark, d):
    return lifecycle.window_retention(adapters.ledger(spark, d), exclude_first_day=True)


@query
def churn_status(spark, d):
    return lifecycle.churn_status(adapters.ledger(spark, d))


@query
def monthly_churn(spark, d):
    return lifecycle.monthly_churn(adapters.ledger(spark, d))


@query
def churn_by_segment(spark, d):
    return lifecycle.churn_by_segment(adapters.ledger(spark, d), _ledger_segments(spark, d))


@query
def pre_churn_behaviour(spark, d):
    return lifecycle.pre_churn_behaviour(
        adapters.ledger(spark, d, sequence=True), _ledger_segments(spark, d)
    )


@query
def monthly_lifecycle(spark, d):
    return lifecycle.monthly_lifecycle(adapters.ledger(spark, d))


@query
def cohort_ltv(spark, d):
    return lifecycle.cohort_ltv(adapters.ledger(spark, d))


@query
def cohort_ltv_30_44(spark, d):
    return lifecycle.cohort_ltv(adapters.ledger(spark, d), mode="days_30_44", per_player=True)


@query
def acquisition_by_persona(spark, d):
    return lifecycle.acquisition_by_persona(adapters.ledger(spark, d), _ledger_personas(spark, d))


@query
def entry_games(spark, d):
    return lifecycle.entry_games(adapters.ledger(spark, d), _ledger_personas(spark, d))


@query
def immediate_churn_by_game(spark, d):
    return lifecycle.immediate_churn_by_game(
        adapters.ledger(spark, d), _ledger_personas(spark, d)
    )


@query
def one_session_churn_by_game(spark, d):
    tx = adapters.ledger(spark, d)
    return lifecycle.immediate_churn_by_game(
        tx, _personas(tx, None), min_starts=5, one_session=True
    )


@query
def active_base(spark, d):
    return lifecycle.active_base(adapters.ledger(spark, d), _ledger_segments(spark, d))


@query
def base_churn(spark, d):
    return lifecycle.base_churn(adapters.ledger(spark, d), _ledger_segments(spark, d))


@query
def net_growth(spark, d):
    return lifecycle.net_growth(adapters.ledger(spark, d), _ledger_segments(spark, d))


@query
def cumulative_flows(spark, d):
    return lifecycle.cumulative_flows(adapters.ledger(spark, d), _ledger_segments(spark, d))


@query
def base_composition(spark, d):
    return lifecycle.base_composition(adapters.ledger(spark, d), _ledger_segments(spark, d))


@query
def retention_weighted_ltv(spark, d):
    return lifecycle.retention_weighted_ltv(
        adapters.ledger(spark, d), _ledger_personas(spark, d)
    )


@query
def lifecycle_headline(spark, d):
    return lifecycle.lifecycle_headline(
        adapters.ledger(spark, d), adapters.market_segments(spark, d)
    )


@query
def weekly_churn(spark, d):
    return lifecycle.weekly_churn(adapters.ledger(spark, d))


@query
def churn_share(spark, d):
    return lifecycle.churn_share(adapters.ledger(spark, d), adapters.market_segments(spark, d))


# --- sources and sinks -------------------------------------------------------------


def _exported(spark: SparkSession, d: str) -> str:
    folder = work_folder(spark)
    files.write_months(adapters.bets(spark, d, sequence=True), f"{folder}/tx")
    return folder


@query
def games_from_csv(spark, d):
    """The games file written and read back, joined to the bets per game."""
    folder = work_folder(spark)
    files.write_csv(adapters.games(spark), f"{folder}/games")
    games = files.read_games(spark, f"{folder}/games")
    used = adapters.bets(spark, d).groupBy("game_id").agg(F.count("*").alias("bets"))
    return games.join(used, "game_id", "left")


@query
def month_export_reload(spark, d):
    """All bets through the monthly csv export, the bronze load and typing."""
    folder = _exported(spark, d)
    bronze = files.read_bronze(spark, f"{folder}/tx", prefix="part")
    tx = files.silver(bronze)
    return tx.groupBy("player_id").agg(
        F.count("*").alias("bets"),
        F.sum("bet_amount").alias("wagered"),
        F.sum("session_balance").alias("balances"),
        F.max("consecutive_losses").alias("longest"),
        F.max("timestamp").alias("last_bet"),
        F.min("date").alias("first_day"),
    )


@query
def bronze_load_report(spark, d):
    """The export and a copy of it with two columns swapped: rows that are loaded, csv outputs left out.

    The copy is written by as many tasks as its rows need, and its part files count as the one output they are.
    """
    path = f"{work_folder(spark)}/tx"
    bets = adapters.bets(spark, d, sequence=True)
    files.write_months(bets, path)
    swapped = ["player_id", "transaction_id", *schema.BRONZE_COLUMNS[2:]]
    other = bets.select(*[F.col(c) if c in bets.columns else F.lit("").alias(c) for c in swapped])
    files.write_csv(other, f"{path}/transactions_month=copy")
    left_out = files.skipped_files(spark, path, prefix="part").select(F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    bronze = files.read_bronze(spark, path, prefix="part")
    return files.row_counts(
        bronze=bronze,
        silver=files.silver(bronze),
        rejects=files.rejects(bronze),
        skipped_files=left_out.distinct(),
    )


@query
def month_files(spark, d):
    """Months found by file discovery after the export, with rows per month."""
    folder = work_folder(spark)
    tx = adapters.ledger(spark, d)
    files.write_months(tx, f"{folder}/tx")
    found = files.discover(spark, f"{folder}/tx", prefix="part").select(
        F.regexp_extract("path", "transactions_month=([0-9-]+)", 1).alias("month")
    )
    rows_per_month = (
        files.read_bronze(spark, f"{folder}/tx", prefix="part")
        .groupBy(F.col("transactions_month").cast("string").alias("month"))
        .agg(F.count("*").alias("bets"))
    )
    return found.distinct().join(rows_per_month, "month")


@query
def incremental_ingest(spark, d):
    """The same export appended to bronze by the file stream."""
    folder = _exported(spark, d)
    ingest.append_new_files(
        spark, f"{folder}/tx", f"{folder}/bronze", f"{folder}/offsets", prefix="part"
    )
    bronze = spark.read.schema(schema.BRONZE).parquet(f"{folder}/bronze")
    return files.silver(bronze).groupBy("game_id").agg(
        F.count("*").alias("bets"), F.sum("net_result").alias("net")
    )


@query
def table_round_trip(spark, d):
    """Daily features as a managed table, read back through a view."""
    name = f"daily_{abs(hash(work_folder(spark)))}"
    tables.replace_table(_daily(spark, d), name)
    out = stored(tables.read_table(spark, name))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    view = tables.create_view(out, f"{name}_view")
    return view.select("date", "game_id", "total_bets", "daily_ggr")


@query
def daily_export_kpis(spark, d):
    """The daily table as csv; the headline falls back where a column is missing."""
    folder = work_folder(spark)
    export = _daily(spark, d).drop("gross_gaming_revenue", "daily_active_users")
    files.write_csv(export, f"{folder}/daily")
    return daily.kpi_strip(files.read_daily(spark, f"{folder}/daily"))


@query
def run_statistics(spark, d):
    tx = adapters.ledger(spark, d)
    flagged = players.with_churn_flag(players.player_summary(tx), tx)
    stats = files.run_statistics(tx, flagged, adapters.market_segments(spark, d))
    return stats.withColumn("churn_by_segment", F.to_json("churn_by_segment"))


@query
def row_counts(spark, d):
    tx = adapters.bets(spark, d)
    return files.row_counts(bets=tx, ledger=adapters.ledger(spark, d), daily=_daily(spark, d))


@query
def preview(spark, d):
    ordered = adapters.bets(spark, d).orderBy("timestamp", "transaction_id")
    return files.preview(ordered, 5).select("transaction_id", "player_id", "game_id", "bet_amount")


@query
def rejected_rows(spark, d):
    """Bets as text with one game's amounts spoiled: how many the typed load refuses."""
    tx = adapters.bets(spark, d)
    spoiled = F.when(F.col("game_id") == "G005", "n/a").otherwise(
        F.col("bet_amount").cast("string")
    )
    bronze = tx.select(
        *[
            (spoiled if c == "bet_amount" else F.col(c).cast("string")).alias(c)
            for c in tx.columns
        ]
    )
    return files.row_counts(
        bronze=bronze, silver=files.silver(bronze), rejects=files.rejects(bronze)
    )


# --- dated store -------------------------------------------------------------------


def _bets_by_day(spark: SparkSession, d: str) -> str:
    """The typed bets in a dated store: two batches of days, then the first day again late.

    The typed log is made once; the batches and the late day are day filters on
    it, each written with dynamic partition overwrite.  Two dates reach the driver.
    """
    tx = stored(adapters.bets(spark, d))
    path = f"{work_folder(spark)}/bets_by_day"
    first, last = tx.agg(F.min("date"), F.max("date")).first()
    if first is None:
        dated.write_days(tx, path)
        return path
    dated.load_in_batches(tx, path, [first + (last - first) / 2])
    dated.write_days(tx.where(F.col("date") == F.lit(first)), path)  # replaces that day, adds nothing
    return path


@query
def dated_store_days(spark, d):
    """Per day of the store, what the whole log holds for that day."""
    store, _ = dated.read_days(spark, _bets_by_day(spark, d))
    return store.groupBy("date").agg(
        F.count("*").alias("bets"),
        F.sum("bet_amount").alias("wagered"),
        F.sum("net_result").alias("net"),
        F.count_distinct("player_id").alias("players"),
    )


@query
def segment_thresholds_dated(spark, d):
    """M1/M2 from the store: the 90-day window is a partition filter."""
    store, as_of = dated.read_days(spark, _bets_by_day(spark, d), 90)
    return segments.segment_thresholds(segments.light_features(store, as_of=as_of))


@query
def daily_by_segment_dated(spark, d):
    """G1 from the store; segments and metrics read the same pruned window."""
    store, as_of = dated.read_days(spark, _bets_by_day(spark, d), 90)
    segs = segments.player_segments(store, as_of=as_of)
    return dashboards.daily_by_segment(store, segs, as_of=as_of)


@query
def game_preference_dated(spark, d):
    """G5 from the store: 30 days of play by the segments of 90 days."""
    store, as_of = dated.read_days(spark, _bets_by_day(spark, d), 90)
    segs = segments.player_segments(store, as_of=as_of)
    return dashboards.game_preference(store, segs, as_of=as_of)


# --- activity bitmaps ----------------------------------------------------------------


def _ledger_bitmaps(spark: SparkSession, d: str) -> DataFrame:
    from wagerscope.plans import bitmaps

    return stored(bitmaps.month_bitmaps(adapters.ledger(spark, d)))


@query
def player_cohorts_bitmaps(spark, d):
    """L4 from the month bitmaps: the cohort is the lowest set bit."""
    from wagerscope.plans import bitmaps

    return _ledger_bitmaps(spark, d).select(
        "player_id", bitmaps.month_start(F.col("cohort")).alias("cohort_month"))


@query
def cohort_retention_bitmaps(spark, d):
    """L5 from the month bitmaps, every index in one aggregate."""
    from wagerscope.plans import bitmaps

    return bitmaps.cohort_retention(_ledger_bitmaps(spark, d))


@query
def cohort_matrix_bitmaps(spark, d):
    """L6 from the month bitmaps."""
    from wagerscope.plans import bitmaps

    return bitmaps.cohort_matrix(_ledger_bitmaps(spark, d))


# --- carried ordered state -------------------------------------------------------------


def _two_loads(spark: SparkSession, d: str) -> DataFrame:
    """Bets sequenced in two loads split at the middle day; the second reads only the stored state."""
    tx = stored(adapters.bets(spark, d))
    spec = {
        "sums": {"net_result": "session_balance"},
        "previous": {"bet_amount": "prev_bet", "net_result": "prev_net"},
        "runs": (F.col("win_amount") > 0, "consecutive_losses", "consecutive_wins"),
    }
    first, last = tx.agg(F.min("date"), F.max("date")).first()
    if first is None:
        return carry.sequenced(tx, None, **spec)[0]
    cut = F.lit(first + (last - first) / 2)
    early, state = carry.sequenced(tx.where(F.col("date") < cut), None, **spec)
    late, _ = carry.sequenced(tx.where(F.col("date") >= cut), stored(state), **spec)
    return early.unionByName(late)


@query
def running_balance_carried(spark, d):
    """P5 over two loads with a carried state."""
    return _two_loads(spark, d).select("transaction_id", "session_id", "session_balance")


@query
def streak_lengths_carried(spark, d):
    """P6 over two loads with a carried state."""
    return _two_loads(spark, d).select("transaction_id", "consecutive_losses", "consecutive_wins")


@query
def previous_bets_carried(spark, d):
    """F7's previous bet over two loads with a carried state."""
    return _two_loads(spark, d).select("transaction_id", "prev_bet", "prev_net")


# --- radix selection ---------------------------------------------------------------


@query
def exact_bet_quantiles_radix(spark, d):
    """P8/M2/G9 quantiles by radix selection: digits counted level by level, no sort."""
    return radix.radix_quantiles(
        adapters.ledger(spark, d), "bet_amount", {"p01": 0.01, "p50": 0.5, "p99": 0.99}, by=["game_id"]
    )
