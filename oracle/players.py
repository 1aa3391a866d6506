"""Twins of the player queries."""

from oracle.common import BETS, LEDGER, MARKET, div, join, mean, sequence, twin

BETS_SEQ = join(BETS, sequence("bets"))


def _mode(source: str, col: str, name: str, out: str) -> str:
    return f"""
{name} AS (
  SELECT player_id, {col} AS {out} FROM (
    SELECT player_id, {col}, row_number() OVER (PARTITION BY player_id
      ORDER BY count(*) DESC, {col}) AS rn FROM {source} GROUP BY player_id, {col})
  WHERE rn = 1
)"""


def base(source: str) -> str:
    return f"""
base AS (
  SELECT player_id, count(*) AS total_bets, CAST(sum(bet_amount) AS DOUBLE) AS total_wagered,
    CAST(sum(win_amount) AS DOUBLE) AS total_winnings,
    CAST(sum(net_result) AS DOUBLE) AS total_net_result,
    abs(CAST(sum(net_result) AS DOUBLE)) AS total_net_loss,
    {mean("bet_amount")} AS avg_bet_amount,
    stddev_pop(CAST(bet_amount AS DOUBLE)) AS stddev_bet_amount,
    quantile_disc(CAST(bet_amount AS DOUBLE), 0.5) AS median_bet_amount,
    CAST(min(bet_amount) AS DOUBLE) AS min_bet_amount,
    CAST(max(bet_amount) AS DOUBLE) AS max_bet_amount,
    coalesce(stddev_pop(CAST(bet_amount AS DOUBLE)) / nullif({mean("bet_amount")}, 0), 0) AS bet_cv,
    count(DISTINCT session_id) AS total_sessions, count(DISTINCT date) AS active_days,
    count(DISTINCT game_id) AS games_played,
    min("timestamp") AS first_bet_date, max("timestamp") AS last_bet_date,
    CAST(max(date) - min(date) AS INTEGER) AS days_active_span,
    count(*) FILTER (net_result > 0) AS winning_bets,
    count(*) FILTER (net_result < 0) AS losing_bets,
    count(*) FILTER (net_result = 0) AS neutral_bets,
    {div("count(*) FILTER (net_result > 0)", "count(*)")} AS win_rate,
    max(consecutive_losses) AS max_consecutive_losses,
    max(consecutive_wins) AS max_consecutive_wins,
    {mean("consecutive_losses")} AS avg_consecutive_losses,
    {mean("is_weekend")} AS weekend_play_pct, {mean("is_peak_hour")} AS peak_hour_play_pct,
    {mean("is_payday")} AS payday_play_pct
  FROM {source} GROUP BY player_id
)"""


BASE_DOUBLES = (
    "total_wagered total_winnings total_net_result total_net_loss avg_bet_amount "
    "stddev_bet_amount median_bet_amount min_bet_amount max_bet_amount bet_cv win_rate "
    "avg_consecutive_losses weekend_play_pct peak_hour_play_pct payday_play_pct"
)

SESSIONS = """
sessions AS (
  SELECT player_id, session_id,
    (floor(epoch(max("timestamp"))) - floor(epoch(min("timestamp")))) / CAST(60 AS DOUBLE)
      AS session_duration_minutes,
    count(*) AS bets_per_session, sum(net_result) AS session_net_result,
    CAST(min(session_balance) AS DOUBLE) AS min_session_balance,
    CAST(max(session_balance) AS DOUBLE) AS max_session_balance,
    CAST(arg_max(session_balance, "timestamp") AS DOUBLE) AS last_session_balance
  FROM bets_seq GROUP BY 1, 2
)"""


def session_stats(worst: str, best: str) -> str:
    return f"""
session_stats AS (
  SELECT player_id, avg(session_duration_minutes) AS avg_session_duration,
    stddev_pop(session_duration_minutes) AS stddev_session_duration,
    {mean("bets_per_session")} AS avg_bets_per_session,
    {mean("session_net_result")} AS avg_session_net_result,
    CAST(min({worst}) AS DOUBLE) AS worst_session_balance,
    CAST(max({best}) AS DOUBLE) AS best_session_result
  FROM sessions GROUP BY player_id
)"""


def recency(source: str) -> str:
    return f"""
recency AS (
  SELECT player_id, CAST(hi - max(date) AS INTEGER) AS days_since_last_bet,
    count(DISTINCT CASE WHEN date >= hi - 7 THEN date END) AS active_days_last_7d,
    count(DISTINCT CASE WHEN date >= hi - 30 THEN date END) AS active_days_last_30d,
    {div("count(DISTINCT date)", "hi - lo + 1")} AS pct_days_active_in_period
  FROM {source}, (SELECT min(date) AS lo, max(date) AS hi FROM {source})
  GROUP BY player_id, lo, hi
)"""


ESCALATION = """
escalation AS (
  SELECT player_id,
    avg(CASE WHEN prev_net < 0 AND bet > prev_bet
      THEN coalesce((bet - prev_bet) / nullif(prev_bet, 0), NULL) ELSE 0 END)
      AS avg_bet_increase_after_loss,
    CAST(sum(CASE WHEN prev_net < 0 AND bet > prev_bet * CAST(1.2 AS DOUBLE) THEN 1 ELSE 0 END)
      AS BIGINT) AS chasing_incidents
  FROM (
    SELECT player_id, CAST(bet_amount AS DOUBLE) AS bet,
      lag(CAST(bet_amount AS DOUBLE)) OVER w AS prev_bet,
      lag(CAST(net_result AS DOUBLE)) OVER w AS prev_net
    FROM bets WINDOW w AS (PARTITION BY player_id, session_id ORDER BY "timestamp", transaction_id))
  GROUP BY player_id
)"""

TRAINING = join(
    BETS_SEQ,
    base("bets_seq"),
    _mode("bets", "day_of_week", "mode_day", "most_common_day"),
    _mode("bets", "hour", "mode_hour", "most_common_hour"),
    SESSIONS,
    session_stats("min_session_balance", "session_net_result"),
    recency("bets"),
    ESCALATION,
    f"""
training AS (
  SELECT player_id, total_wagered, total_net_loss, avg_bet_amount, median_bet_amount,
    total_sessions, active_days, {div("total_sessions", "active_days")} AS sessions_per_day,
    {div("total_bets", "total_sessions")} AS bets_per_session,
    coalesce({div("active_days", "days_active_span")}, 0) AS activity_ratio,
    stddev_bet_amount, bet_cv AS bet_volatility_coefficient, max_bet_amount, min_bet_amount,
    win_rate, winning_bets, losing_bets, max_consecutive_losses, avg_consecutive_losses,
    avg_bet_increase_after_loss, chasing_incidents, avg_session_duration,
    stddev_session_duration, avg_session_net_result, worst_session_balance, weekend_play_pct,
    peak_hour_play_pct, payday_play_pct, most_common_day, most_common_hour,
    days_since_last_bet, active_days_last_7d, active_days_last_30d, pct_days_active_in_period,
    games_played, first_bet_date, last_bet_date, days_active_span,
    CASE WHEN avg_bet_amount > 100 THEN 2 ELSE 0 END
      + CASE WHEN total_net_loss > 10000 THEN 2 ELSE 0 END
      + CASE WHEN max_consecutive_losses > 5 THEN 1 ELSE 0 END
      + CASE WHEN chasing_incidents > 10 THEN 2 ELSE 0 END
      + CASE WHEN bet_cv > 1.0 THEN 1 ELSE 0 END AS preliminary_risk_score
  FROM base LEFT JOIN mode_day USING (player_id) LEFT JOIN mode_hour USING (player_id)
    LEFT JOIN session_stats USING (player_id) LEFT JOIN recency USING (player_id)
    LEFT JOIN escalation USING (player_id)
  WHERE total_bets >= 10 AND active_days >= 2
)""",
)
TRAINING_DOUBLES = (
    "total_wagered total_net_loss avg_bet_amount median_bet_amount sessions_per_day "
    "bets_per_session activity_ratio stddev_bet_amount bet_volatility_coefficient max_bet_amount "
    "min_bet_amount win_rate avg_consecutive_losses avg_bet_increase_after_loss "
    "avg_session_duration stddev_session_duration avg_session_net_result worst_session_balance "
    "weekend_play_pct peak_hour_play_pct payday_play_pct pct_days_active_in_period"
)

DAYS_ACTIVE = """CAST(floor((floor(epoch(max("timestamp"))) - floor(epoch(min("timestamp")))) / 86400)
    + 1 AS INTEGER)"""

SUMMARY_DOUBLES = (
    "total_wagered avg_bet_amount stddev_bet_amount min_bet_amount max_bet_amount total_winnings "
    "total_net_result total_net_loss weekend_play_pct peak_hour_play_pct payday_play_pct bet_cv "
    "win_rate median_bet_amount avg_session_duration stddev_session_duration "
    "avg_bets_per_session avg_session_net_result worst_session_balance best_session_balance "
    "sessions_per_day bets_per_session activity_ratio"
)


def _session_extremes(worst: str, best: str) -> str:
    return twin(
        join(BETS_SEQ, SESSIONS, session_stats(worst, best)),
        "SELECT player_id, worst_session_balance, best_session_result FROM session_stats",
        "worst_session_balance best_session_result",
    )


SQL = {
    "player_base": twin(join(BETS_SEQ, base("bets_seq")), "SELECT * FROM base", BASE_DOUBLES),
    "most_common_times": twin(
        join(
            BETS,
            _mode("bets", "day_of_week", "mode_day", "most_common_day"),
            _mode("bets", "hour", "mode_hour", "most_common_hour"),
        ),
        "SELECT * FROM mode_day JOIN mode_hour USING (player_id)",
    ),
    "distinct_rows": twin(LEDGER, "SELECT DISTINCT player_id, game_id, date FROM ledger"),
    "session_rollup": twin(
        join(BETS_SEQ, SESSIONS),
        "SELECT * FROM sessions",
        "session_duration_minutes session_net_result min_session_balance max_session_balance "
        "last_session_balance",
    ),
    "session_features": twin(
        join(BETS_SEQ, SESSIONS, session_stats("min_session_balance", "session_net_result")),
        "SELECT * FROM session_stats",
        "avg_session_duration stddev_session_duration avg_bets_per_session "
        "avg_session_net_result worst_session_balance best_session_result",
    ),
    "session_features_peak": _session_extremes("max_session_balance", "max_session_balance"),
    "session_features_closing": _session_extremes("last_session_balance", "last_session_balance"),
    "recency_features": twin(
        join(BETS, recency("bets")), "SELECT * FROM recency", "pct_days_active_in_period"
    ),
    "ledger_recency_features": twin(
        join(LEDGER, recency("ledger")), "SELECT * FROM recency", "pct_days_active_in_period"
    ),
    "bet_escalation": twin(
        join(BETS, ESCALATION), "SELECT * FROM escalation", "avg_bet_increase_after_loss"
    ),
    "training_features": twin(TRAINING, "SELECT * FROM training", TRAINING_DOUBLES),
    "risk_scores": twin(
        TRAINING,
        "SELECT preliminary_risk_score, count(*) AS players FROM training GROUP BY 1",
    ),
    "summary_features": twin(
        join(BETS_SEQ, SESSIONS, ESCALATION),
        f"""SELECT * REPLACE (coalesce(stddev_bet_amount, 0) AS stddev_bet_amount,
          coalesce(bet_cv, 0) AS bet_cv,
          coalesce(stddev_session_duration, 0) AS stddev_session_duration) FROM (
        SELECT player_id, count(*) AS total_bets, sum(bet_amount) AS total_wagered,
          {mean("bet_amount")} AS avg_bet_amount,
          stddev_samp(CAST(bet_amount AS DOUBLE)) AS stddev_bet_amount,
          min(bet_amount) AS min_bet_amount, max(bet_amount) AS max_bet_amount,
          sum(win_amount) AS total_winnings, sum(net_result) AS total_net_result,
          abs(sum(net_result)) AS total_net_loss,
          max(consecutive_losses) AS max_consecutive_losses,
          max(consecutive_wins) AS max_consecutive_wins,
          {mean("is_weekend")} AS weekend_play_pct, {mean("is_peak_hour")} AS peak_hour_play_pct,
          {mean("is_payday")} AS payday_play_pct,
          stddev_samp(CAST(bet_amount AS DOUBLE)) / nullif({mean("bet_amount")}, 0) AS bet_cv,
          {DAYS_ACTIVE} AS days_active_span,
          count(*) FILTER (net_result > 0) AS winning_bets,
          count(*) FILTER (net_result < 0) AS losing_bets,
          count(*) FILTER (net_result = 0) AS neutral_bets,
          {div("count(*) FILTER (net_result > 0)", "count(*)")} AS win_rate,
          quantile_cont(CAST(bet_amount AS DOUBLE), 0.5) AS median_bet_amount,
          count(DISTINCT session_id) AS total_sessions, count(DISTINCT date) AS active_days,
          count(DISTINCT game_id) AS games_played,
          any_value(avg_session_duration) AS avg_session_duration,
          any_value(stddev_session_duration) AS stddev_session_duration,
          any_value(avg_bets_per_session) AS avg_bets_per_session,
          any_value(avg_session_net_result) AS avg_session_net_result,
          any_value(worst_session_balance) AS worst_session_balance,
          any_value(best_session_balance) AS best_session_balance,
          any_value(chasing_incidents) AS chasing_incidents,
          {div("count(DISTINCT session_id)", "count(DISTINCT date)")} AS sessions_per_day,
          {div("count(*)", "count(DISTINCT session_id)")} AS bets_per_session,
          {div("count(DISTINCT date)", DAYS_ACTIVE)} AS activity_ratio,
          CAST((SELECT max(date) FROM bets) - max(date) AS INTEGER) AS days_since_last_bet
        FROM bets_seq
        LEFT JOIN (
          SELECT player_id, avg(session_duration_minutes) AS avg_session_duration,
            stddev_samp(session_duration_minutes) AS stddev_session_duration,
            {mean("bets_per_session")} AS avg_bets_per_session,
            {mean("session_net_result")} AS avg_session_net_result,
            min(last_session_balance) AS worst_session_balance,
            max(last_session_balance) AS best_session_balance
          FROM sessions GROUP BY player_id) USING (player_id)
        LEFT JOIN escalation USING (player_id)
        GROUP BY player_id)""",
        SUMMARY_DOUBLES,
    ),
    "player_summary": twin(
        join(LEDGER, MARKET),
        f"""SELECT *, {div("lifetime_value", "days_active")} AS avg_daily_value FROM (
        SELECT player_id, any_value(player_segment) AS segment,
          count(transaction_id) AS total_bets, CAST(sum(bet_amount) AS DOUBLE) AS total_wagered,
          {mean("bet_amount")} AS avg_bet,
          stddev_samp(CAST(bet_amount AS DOUBLE)) AS bet_volatility,
          CAST(sum(win_amount) AS DOUBLE) AS total_won,
          CAST(sum(net_result) AS DOUBLE) AS net_loss,
          count(DISTINCT session_id) AS total_sessions, min("timestamp") AS first_bet,
          max("timestamp") AS last_bet, {DAYS_ACTIVE} AS days_active,
          -CAST(sum(net_result) AS DOUBLE) AS lifetime_value
        FROM ledger LEFT JOIN market USING (player_id) GROUP BY player_id)""",
        "total_wagered avg_bet bet_volatility total_won net_loss lifetime_value avg_daily_value",
    ),
    "player_churn_flags": twin(
        LEDGER,
        """SELECT player_id, hi - max(date) > 60 AS is_churned,
        CASE WHEN hi - max(date) > 60 THEN max(date) END AS churn_date
        FROM ledger, (SELECT max(date) AS hi FROM ledger) GROUP BY player_id, hi""",
    ),
}
