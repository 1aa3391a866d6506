"""Acquisition, retention, churn and lifetime value.

Everything after the first bet starts from one row per player and month (or
day), so cohort joins and windows work on active periods, not on bets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagerscope.functions import calendar, scans
from wagerscope.functions.metrics import mean, money_sum, pct, ratio
from wagerscope.operators.rows import label_contains
from wagerscope.plans.activity import player_bounds, player_days, player_months
from wagerscope.schema import SEGMENTS

# One row per month or week by the time these are used.
def _by_month() -> Window:
    return Window.orderBy("month")


def _up_to_month() -> Window:
    return _by_month().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _segment_of(segments: DataFrame) -> DataFrame:
    return segments.select("player_id", "player_segment")


def _label_of(labels: DataFrame) -> DataFrame:
    return labels.select("player_id", "label")


# --- acquisition ---------------------------------------------------------------


def first_activity(tx: DataFrame) -> DataFrame:
    """L1: day, time, game and amount of each player's first bet."""
    first = F.min_by(F.struct("game_id", "bet_amount"), F.struct("timestamp", "transaction_id"))
    return (
        tx.groupBy("player_id")
        .agg(
            F.min("date").alias("acquisition_date"),
            F.min("timestamp").alias("first_bet_timestamp"),
            first.alias("first"),
        )
        .select(
            "player_id",
            "acquisition_date",
            "first_bet_timestamp",
            F.col("first.game_id").alias("first_game_played"),
            F.col("first.bet_amount").alias("first_bet_amount"),
        )
    )


def monthly_acquisition(
    tx: DataFrame, slot_prefix: str = "G001", table_prefix: str = "G002", accuracy: int = 10_000
) -> DataFrame:
    """L2: new players per month, growth, first bets and entry game kinds."""
    started = F.col("first_game_played")
    by_month = (
        first_activity(tx)
        .groupBy(calendar.month_of("acquisition_date").alias("month"))
        .agg(
            F.count("player_id").alias("new_players"),
            mean("first_bet_amount").alias("avg_first_bet"),
            F.percentile_approx("first_bet_amount", 0.5, accuracy)
            .cast("double")
            .alias("median_first_bet"),
            F.count_if(started.startswith(slot_prefix)).alias("slots"),
            F.count_if(started.startswith(table_prefix)).alias("tables"),
        )
    )
    before = F.lag("new_players").over(_by_month())
    return by_month.select(
        F.col("month").alias("acquisition_month"),
        "new_players",
        pct(F.col("new_players") - before, before).alias("mom_growth_pct"),
        F.sum("new_players").over(_up_to_month()).alias("cumulative_acquired"),
        F.round("avg_first_bet", 2).alias("avg_first_bet"),
        F.round("median_first_bet", 2).alias("median_first_bet"),
        pct(F.col("slots"), F.col("new_players")).alias("pct_started_slots"),
        pct(F.col("tables"), F.col("new_players")).alias("pct_started_tables"),
    ).orderBy("acquisition_month")


def acquisition_by_segment(tx: DataFrame, segments: DataFrame) -> DataFrame:
    """L3: new players per month and segment, and the segment's share of the month."""
    joined = player_bounds(tx).join(_segment_of(segments), "player_id")
    counted = joined.groupBy(
        calendar.month_of("first_date").alias("acquisition_month"), "player_segment"
    ).agg(F.count_distinct("player_id").alias("new_players"))
    of_month = F.sum("new_players").over(Window.partitionBy("acquisition_month"))
    return counted.withColumn(
        "pct_of_monthly_acquisition", pct(F.col("new_players"), of_month)
    ).orderBy("acquisition_month", "player_segment")


# --- cohorts ---------------------------------------------------------------------


def player_cohorts(tx: DataFrame) -> DataFrame:
    """L4: the month of each player's first bet."""
    return player_bounds(tx).select(
        "player_id", calendar.month_of("first_date").alias("cohort_month")
    )


def cohort_activity(tx: DataFrame, mode: str = "calendar") -> DataFrame:
    """L4: active months per player with the cohort and the month's index in it."""
    # A player has at most one row per month here.
    months = scans.sliced(player_months(tx), "player_id").withColumn(
        "cohort_month", F.min("month").over(Window.partitionBy("player_id"))
    )
    return months.withColumn(
        "months_since_acquisition",
        calendar.month_index(F.col("month"), F.col("cohort_month"), mode),
    )


def _actives(activity: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    return activity.groupBy(*keys, "months_since_acquisition").agg(
        F.count_distinct("player_id").alias("active_players"), *more
    )


def _cohort_size(keys: Sequence[str]) -> Column:
    # Every player is active in the cohort's own month.
    at_start = F.when(F.col("months_since_acquisition") == 0, F.col("active_players"))
    return F.max(at_start).over(Window.partitionBy(*keys))


def cohort_retention(
    tx: DataFrame, max_months: int | None = 12, mode: str = "calendar"
) -> DataFrame:
    """Active players per cohort and month index, against the cohort's size.

    With ``days_30_44`` the first neighbouring month can fall into index 0, so
    the size is counted over players, not read off index 0.
    """
    activity = cohort_activity(tx, mode)
    own_month = F.count_if(F.col("month") == F.col("cohort_month")).alias("_starters")
    counted = _actives(activity, ["cohort_month"], own_month)
    size = F.max("_starters").over(Window.partitionBy("cohort_month"))
    out = counted.withColumn("cohort_size", size)
    if max_months is not None:
        out = out.where(F.col("months_since_acquisition") <= max_months)
    return out.select(
        "cohort_month",
        "months_since_acquisition",
        "active_players",
        "cohort_size",
        pct(F.col("active_players"), F.col("cohort_size")).alias("retention_pct"),
        ratio("active_players", "cohort_size").alias("retention_rate"),
    )


def cohort_matrix(tx: DataFrame, max_months: int = 12, mode: str = "calendar") -> DataFrame:
    """One row per cohort with ``month_0`` .. ``month_12``.

    The month list is fixed, so no extra job looks for the pivot's values.
    """
    indexes = list(range(max_months + 1))
    wide = (
        cohort_retention(tx, max_months, mode)
        .groupBy("cohort_month", "cohort_size")
        .pivot("months_since_acquisition", indexes)
        .agg(F.max("retention_pct"))
    )
    return wide.select(
        "cohort_month",
        "cohort_size",
        *[F.col(str(i)).alias(f"month_{i}") for i in indexes],
    ).orderBy("cohort_month")


def retention_by_segment(
    tx: DataFrame, segments: DataFrame, max_months: int = 12, mode: str = "calendar"
) -> DataFrame:
    """Retention per segment and month index, averaged over cohorts."""
    keys = ["player_segment", "cohort_month"]
    activity = cohort_activity(tx, mode).join(_segment_of(segments), "player_id")
    own_month = F.count_if(F.col("month") == F.col("cohort_month")).alias("_starters")
    counted = _actives(activity, keys, own_month)
    size = F.max("_starters").over(Window.partitionBy(*keys))
    share = (
        counted.withColumn("cohort_size", size)
        .where(F.col("months_since_acquisition") <= max_months)
        .withColumn("retention", ratio(F.col("active_players") * 100.0, "cohort_size"))
    )
    return (
        share.groupBy("player_segment", "months_since_acquisition")
        .agg(
            F.round(F.avg("retention"), 1).alias("avg_retention_pct"),
            F.round(F.stddev_pop("retention"), 1).alias("stddev_retention"),
            F.round(F.min("retention"), 1).alias("min_retention_pct"),
            F.round(F.max("retention"), 1).alias("max_retention_pct"),
            F.count_distinct("cohort_month").alias("num_cohorts"),
        )
        .orderBy("player_segment", "months_since_acquisition")
    )


def retention_by_persona(tx: DataFrame, labels: DataFrame, max_months: int = 12) -> DataFrame:
    """Decay per persona over months 1 .. 12, against its month-0 players."""
    activity = cohort_activity(tx).join(_label_of(labels), "player_id")
    counted = _actives(activity, ["label"]).withColumn("total_users", _cohort_size(["label"]))
    return counted.where(F.col("months_since_acquisition").between(1, max_months)).select(
        "label",
        "months_since_acquisition",
        F.col("active_players").alias("active_users"),
        "total_users",
        ratio("active_players", "total_users").alias("retention_pct"),
    )


def window_retention(tx: DataFrame, as_of=None, exclude_first_day: bool = False) -> DataFrame:
    """Share of mature players active 30, 60, 90 days in, and in days 30-60.

    The windows start with the first bet itself, so the first three shares are
    100 unless ``exclude_first_day`` asks for a bet on a later day.
    """
    days = tx.select("player_id", "date").distinct()
    first = F.min("date").over(Window.partitionBy("player_id"))
    known = days.withColumn("first_date", first).where(
        F.col("first_date") <= F.date_sub(calendar.anchor(tx, as_of), 90)
    )
    day, start = F.col("date"), F.col("first_date")

    def active(from_day: int, to_day: int) -> Column:
        hit = day.between(F.date_add(start, from_day), F.date_add(start, to_day))
        if exclude_first_day:
            hit = hit & (day > start)
        return F.max(hit.cast("int"))

    flags = known.groupBy("player_id").agg(
        active(0, 30).alias("a30"),
        active(0, 60).alias("a60"),
        active(0, 90).alias("a90"),
        active(30, 60).alias("back"),
    )
    n = F.count("*")
    return flags.agg(
        n.alias("total_players"),
        pct(F.sum("a30"), n).alias("retention_30d_pct"),
        pct(F.sum("a60"), n).alias("retention_60d_pct"),
        pct(F.sum("a90"), n).alias("retention_90d_pct"),
        pct(F.sum("back"), n).alias("reactivation_30_60d_pct"),
    )


# --- churn -----------------------------------------------------------------------


def _idle_players(tx: DataFrame, as_of=None) -> DataFrame:
    return player_bounds(tx).withColumn(
        "days_since_last_bet", F.datediff(calendar.anchor(tx, as_of), F.col("last_date"))
    )


def churn_status(tx: DataFrame, as_of=None) -> DataFrame:
    """Players by how long they have been idle, from active to long gone."""
    idle = F.col("days_since_last_bet")
    # Status names and day limits, both ends as listed.
    status = (
        F.when(idle <= 30, "Active")
        .when(idle <= 60, "At Risk")
        .when(idle <= 90, "Churned (Recent)")
        .otherwise("Churned (Long-term)")
    )
    rank = F.when(idle <= 30, 1).when(idle <= 60, 2).when(idle <= 90, 3).otherwise(4)
    counted = (
        _idle_players(tx, as_of)
        .groupBy(status.alias("churn_status"), rank.alias("_rank"))
        .agg(
            F.count("player_id").alias("player_count"),
            F.round(mean("days_since_last_bet"), 1).alias("avg_days_inactive"),
        )
    )
    total = F.sum("player_count").over(Window.partitionBy())
    return counted.orderBy("_rank").select(
        "churn_status",
        "player_count",
        pct(F.col("player_count"), total).alias("pct_of_total"),
        "avg_days_inactive",
    )


def _monthly_actives(tx: DataFrame) -> DataFrame:
    return player_months(tx).groupBy("month").agg(F.count("player_id").alias("active_players"))


def monthly_churn(tx: DataFrame) -> DataFrame:
    """Change of the active base against the month before.

    A net change: negative when the base grew.
    """
    now, before = F.col("active_players"), F.lag("active_players").over(_by_month())
    return (
        _monthly_actives(tx)
        .select(
            "month",
            now.alias("active_end_of_month"),
            before.alias("active_start_of_month"),
            (before - now).alias("churned_players"),
            pct(before - now, before, 2).alias("monthly_churn_rate_pct"),
        )
        .orderBy("month")
    )


def churn_by_segment(
    tx: DataFrame, segments: DataFrame, churn_days: int = 60, as_of=None
) -> DataFrame:
    """Churned players per segment and how long they have been idle."""
    joined = _segment_of(segments).join(_idle_players(tx, as_of), "player_id")
    gone = F.col("days_since_last_bet") > churn_days
    total = F.count_distinct("player_id")
    churned = F.count_distinct(F.when(gone, F.col("player_id")))
    return (
        joined.groupBy("player_segment")
        .agg(
            total.alias("total_players"),
            churned.alias("churned_players"),
            pct(churned, total).alias("churn_rate_pct"),
            F.round(mean(F.when(gone, F.col("days_since_last_bet"))), 0).alias(
                "avg_days_inactive_for_churned"
            ),
        )
        .orderBy("churn_rate_pct", "player_segment")
    )


def pre_churn_behaviour(
    tx: DataFrame,
    segments: DataFrame,
    churn_days: int = 60,
    window_days: int = 30,
    large_loss: float = 500,
    as_of=None,
) -> DataFrame:
    """The last days of churned players before they left, per segment.

    Players without a segment form their own row.
    """
    gone = (
        _idle_players(tx, as_of)
        .where(F.col("days_since_last_bet") > churn_days)
        .select("player_id", F.col("last_date").alias("churn_date"))
    )
    cells = tx.groupBy("player_id", "date", "session_id").agg(
        F.count("*").alias("bets"),
        F.sum("bet_amount").alias("wagered"),
        F.sum("net_result").alias("net"),
        F.max("consecutive_losses").alias("streak"),
    )
    last_days = cells.join(gone, "player_id").where(
        F.col("date").between(F.date_sub("churn_date", window_days), F.col("churn_date"))
    )
    per_player = last_days.groupBy("player_id").agg(
        F.count_distinct("session_id").alias("sessions"),
        F.sum("bets").alias("bets"),
        F.sum("wagered").alias("wagered"),
        F.sum("net").alias("net"),
        F.max("streak").alias("streak"),
        (F.sum("net") < -large_loss).cast("int").alias("big_loss"),
    )
    return (
        per_player.join(_segment_of(segments), "player_id", "left")
        .groupBy("player_segment")
        .agg(
            F.count("*").alias("churned_players"),
            F.round(mean("sessions"), 1).alias("avg_sessions_before_churn"),
            F.round(mean("bets"), 0).alias("avg_bets_before_churn"),
            F.round(mean("wagered"), 2).alias("avg_wagered_before_churn"),
            F.round(mean("net"), 2).alias("avg_net_result_before_churn"),
            F.round(mean("streak"), 1).alias("avg_max_consecutive_losses"),
            pct(F.sum("big_loss"), F.count("*")).alias("pct_churned_after_big_loss"),
        )
        .orderBy("player_segment")
    )


def monthly_lifecycle(tx: DataFrame) -> DataFrame:
    """New, active and lost players per month.

    Lost players are the base's decrease, never below 0, and 0 in the first month.
    """
    now, before = F.col("active_players"), F.lag("active_players").over(_by_month())
    gained = F.col("new_players")
    lost = F.greatest(before - now, F.lit(0))
    per_month = cohort_activity(tx).groupBy("month").agg(
        F.count("player_id").alias("active_players"),
        F.count_if(F.col("month") == F.col("cohort_month")).alias("new_players"),
    )
    return per_month.select(
        "month",
        gained,
        now.alias("total_active_players"),
        before.alias("active_previous_month"),
        lost.alias("churned_players"),
        (gained - lost).alias("net_growth"),
        pct(now, before).alias("retention_rate_pct"),
        pct(now - before, before).alias("mom_growth_pct"),
    ).orderBy("month")


def cohort_ltv(
    tx: DataFrame, mode: str = "calendar", per_player: bool = False
) -> DataFrame:
    """What a cohort lost in 12 months and revenue per active player by month.

    ``ltv_12m`` is the cohort's total, or per cohort member with ``per_player``.
    """
    activity = cohort_activity(tx, mode)
    own_month = F.count_if(F.col("month") == F.col("cohort_month")).alias("_starters")
    counted = _actives(activity, ["cohort_month"], money_sum("lost").alias("ggr"), own_month)
    per_month = counted.withColumn("arpu", ratio("ggr", "active_players"))
    index = F.col("months_since_acquisition")

    def arpu_at(month: int) -> Column:
        return F.max(F.when(index == month, F.col("arpu"))).alias(f"month_{month}_arpu")

    total = F.sum(F.when(index <= 12, F.col("ggr")))
    value = ratio(total, F.max("_starters")) if per_player else total
    return (
        per_month.groupBy("cohort_month")
        .agg(value.alias("ltv_12m"), *[arpu_at(m) for m in (0, 1, 3, 6, 12)])
        .orderBy("cohort_month")
    )


# --- personas --------------------------------------------------------------------


def acquisition_by_persona(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """New players per cohort month and persona."""
    return (
        player_cohorts(tx)
        .join(_label_of(labels), "player_id")
        .groupBy("cohort_month", "label")
        .agg(F.count("*").alias("count"))
        .orderBy("cohort_month", "label")
    )


def _first_day_games(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """Bets of each player's first day, one row per player and game."""
    # A player has at most one row per day and game here.
    first = F.min("date").over(Window.partitionBy("player_id"))
    cells = scans.sliced(player_days(tx, "game_id"), "player_id").withColumn("_first", first)
    return cells.where(F.col("date") == F.col("_first")).join(_label_of(labels), "player_id")


def entry_games(
    tx: DataFrame, labels: DataFrame, persona: str = "Whale", top: int = 10
) -> DataFrame:
    """The games a persona's players bet on most on their first day."""
    return (
        _first_day_games(tx, labels)
        .where(label_contains(persona))
        .groupBy("game_id")
        .agg(F.sum("bets").alias("count"))
        .orderBy(F.desc("count"), "game_id")
        .limit(top)
    )


def immediate_churn_by_game(
    tx: DataFrame,
    labels: DataFrame,
    persona: str = "Tourist",
    min_starts: int = 50,
    top: int = 10,
    one_session: bool = False,
) -> DataFrame:
    """First-day bets per game, and how many came from players who did not stay.

    Such players are told by their persona, or with ``one_session`` by never
    having opened a second session.
    """
    starts = _first_day_games(tx, labels)
    if one_session:
        sessions = (
            tx.select("player_id", "session_id")
            .distinct()
            .groupBy("player_id")
            .agg(F.count("*").alias("_sessions"))
        )
        starts = starts.join(sessions, "player_id")
        left = F.col("_sessions") == 1
    else:
        left = label_contains(persona)
    return (
        starts.groupBy("game_id")
        .agg(
            F.sum("bets").alias("total_starts"),
            F.sum(F.when(left, F.col("bets")).otherwise(0)).alias("churned_players"),
        )
        .withColumn("churn_rate", ratio("churned_players", "total_starts"))
        .where(F.col("total_starts") > min_starts)
        .orderBy(F.desc("churn_rate"), "game_id")
        .limit(top)
    )


# --- active base -----------------------------------------------------------------


def active_base(tx: DataFrame, segments: DataFrame) -> DataFrame:
    """Active players per month and segment."""
    return (
        player_months(tx)
        .join(_segment_of(segments), "player_id")
        .groupBy("month", "player_segment")
        .agg(F.count("player_id").alias("active_players"))
    )


def _dense_base(tx: DataFrame, segments: DataFrame) -> DataFrame:
    """Active, new and previous players for every month of every segment.

    A row also stands for the empty months after it, and a segment's first row
    for those before it, so the calendar is filled without joining a grid.
    """
    base = (
        cohort_activity(tx)
        .join(_segment_of(segments), "player_id")
        .groupBy("month", "player_segment")
        .agg(
            F.count("player_id").alias("active"),
            F.count_if(F.col("month") == F.col("cohort_month")).alias("new"),
        )
    )
    # One row per month and segment, so these windows are small.
    ordered = Window.partitionBy("player_segment").orderBy("month")
    everything = Window.partitionBy()
    until = F.coalesce(
        F.add_months(F.lead("month").over(ordered), -1), F.max("month").over(everything)
    )
    since = F.when(F.lag("month").over(ordered).isNull(), F.min("month").over(everything))
    spans = base.select(
        "player_segment",
        F.col("month").alias("_own"),
        "active",
        "new",
        F.coalesce(since, F.col("month")).alias("_since"),
        until.alias("_until"),
    )
    months = F.explode(F.sequence("_since", "_until", F.expr("interval 1 month")))
    own = F.col("month") == F.col("_own")
    filled = spans.withColumn("month", months).select(
        "month",
        "player_segment",
        *[F.when(own, F.col(c)).otherwise(0).alias(c) for c in ("active", "new")],
    )
    return filled.withColumn("start", F.lag("active").over(ordered))


def _churn_rate() -> Column:
    return ratio(F.col("start") - F.col("active"), "start", 0) * 100


def base_churn(tx: DataFrame, segments: DataFrame) -> DataFrame:
    """Change of each segment's base per month, months without players included."""
    return (
        _dense_base(tx, segments)
        .where(F.col("start").isNotNull())
        .select(
            "month",
            "player_segment",
            F.col("start").alias("active_start"),
            F.col("active").alias("active_end"),
            (F.col("start") - F.col("active")).alias("churned"),
            _churn_rate().alias("churn_rate_pct"),
        )
    )


def _acquired_and_churned(tx: DataFrame, segments: DataFrame) -> DataFrame:
    """Per month over all segments; a month with only one of them has 0 for the other."""
    return (
        _dense_base(tx, segments)
        .groupBy("month")
        .agg(
            F.sum("new").alias("acquired"),
            F.coalesce(F.sum(F.col("start") - F.col("active")), F.lit(0)).alias("churned"),
        )
    )


def net_growth(tx: DataFrame, segments: DataFrame) -> DataFrame:
    """Acquired minus churned per month."""
    return _acquired_and_churned(tx, segments).withColumn(
        "net_growth", F.col("acquired") - F.col("churned")
    )


def cumulative_flows(tx: DataFrame, segments: DataFrame) -> DataFrame:
    """Running totals of acquired and churned players."""
    return _acquired_and_churned(tx, segments).select(
        "month",
        F.sum("acquired").over(_up_to_month()).alias("cumulative_acquired"),
        F.sum("churned").over(_up_to_month()).alias("cumulative_churned"),
    )


def base_composition(
    tx: DataFrame, segments: DataFrame, names: Sequence[str] = SEGMENTS
) -> DataFrame:
    """Each segment's share of the month's active base, one column per segment."""
    of_month = F.sum("active_players").over(Window.partitionBy("month"))
    share = active_base(tx, segments).withColumn(
        "pct", ratio(F.col("active_players") * 100.0, of_month)
    )
    return share.groupBy("month").pivot("player_segment", list(names)).agg(F.max("pct"))


def retention_weighted_ltv(
    tx: DataFrame, labels: DataFrame, acquisition_cost: float = 50.0, max_months: int = 12
) -> DataFrame:
    """First-month revenue per player, weighted with retention over 12 months.

    ``roi_pct`` is the profit over the cost of acquiring one player.
    """
    activity = cohort_activity(tx).join(_label_of(labels), "player_id")
    index = F.col("months_since_acquisition")
    house_win = (0 - F.sum(F.when(index == 0, F.col("net_result")))).alias("_win")
    counted = activity.groupBy("label", "months_since_acquisition").agg(
        F.count_distinct("player_id").alias("active_players"), house_win
    )
    sized = counted.withColumn("total_users", _cohort_size(["label"])).where(
        index.between(0, max_months)
    )
    per_label = sized.groupBy("label").agg(
        ratio(F.max("_win"), F.max("total_users")).alias("month_0_arpu"),
        ratio(F.sum("active_players"), F.max("total_users")).alias("retained_months"),
    )
    value = F.col("month_0_arpu") * F.col("retained_months")
    return per_label.select(
        "label",
        "month_0_arpu",
        "retained_months",
        value.alias("ltv_12m"),
        (ratio(value - acquisition_cost, F.lit(acquisition_cost)) * 100).alias("roi_pct"),
    )


def lifecycle_headline(tx: DataFrame, segments: DataFrame) -> DataFrame:
    """Acquired, churned, net growth, final base and mean churn rate in one row."""
    last = F.max("month").over(Window.partitionBy())
    dense = _dense_base(tx, segments).withColumn("_last", last)
    acquired, churned = F.sum("new"), F.sum(F.col("start") - F.col("active"))
    at_end = F.when(F.col("month") == F.col("_last"), F.col("active"))
    return dense.agg(
        acquired.alias("total_acquired"),
        churned.alias("total_churned"),
        (acquired - churned).alias("net_growth"),
        F.sum(at_end).alias("final_active"),
        F.avg(F.when(F.col("start").isNotNull(), _churn_rate())).alias("avg_churn_rate_pct"),
    )


def weekly_churn(tx: DataFrame, churn_days: int = 60, as_of=None) -> DataFrame:
    """Per week, players gone for good so far and players left.

    A player leaves in the week of the last bet, if idle for over ``churn_days`` since.
    """
    idle = _idle_players(tx, as_of)
    weeks_of = calendar.week_of
    gone = (
        idle.where(F.col("days_since_last_bet") > churn_days)
        .groupBy(weeks_of("last_date").alias("date"))
        .agg(F.count("player_id").alias("_gone"))
    )
    span = idle.agg(
        weeks_of(F.min("first_date")).alias("low"),
        weeks_of(F.max("last_date")).alias("high"),
        F.count("player_id").alias("players"),
    )
    weeks = span.select(
        "players",
        F.explode(F.sequence("low", "high", F.expr("interval 7 days"))).alias("date"),
    )
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = weeks.join(gone, "date", "left").select(
        "date",
        "players",
        F.row_number().over(Window.orderBy("date")).alias("week"),
        F.sum(F.coalesce("_gone", F.lit(0))).over(so_far).alias("churned_cumulative"),
    )
    return counted.select(
        "week",
        "date",
        "churned_cumulative",
        (F.col("players") - F.col("churned_cumulative")).alias("active_players"),
    )


def churn_share(
    tx: DataFrame, segments: DataFrame, churn_days: int = 60, as_of=None
) -> DataFrame:
    """Churned and total players per segment."""
    joined = _segment_of(segments).join(_idle_players(tx, as_of), "player_id")
    gone = F.count_if(F.col("days_since_last_bet") > churn_days)
    return joined.groupBy("player_segment").agg(
        gone.alias("churned"),
        F.count("player_id").alias("total"),
        ratio(gone * 100.0, F.count("player_id"), 0).alias("churned_pct"),
    )
