"""Twins of the daily queries."""

from oracle.common import BETS, GAMES, LEDGER, div, join, mean, twin


def growth(source: str) -> str:
    return f"""
growth AS (
  SELECT first_day AS date, count(player_id) AS new_players_today,
    CAST(sum(count(player_id)) OVER (ORDER BY first_day ROWS UNBOUNDED PRECEDING) AS BIGINT)
      AS cumulative_player_base
  FROM (SELECT player_id, CAST(min("timestamp") AS DATE) AS first_day FROM {source} GROUP BY 1)
  GROUP BY first_day
)"""


DAILY = join(
    BETS,
    GAMES,
    growth("bets"),
    f"""
daily AS (
  SELECT t.date, t.game_id, coalesce(any_value(g.cumulative_player_base), 0) AS cumulative_player_base,
    count(DISTINCT player_id) AS daily_active_users,
    CAST(sum(bet_amount) AS DOUBLE) AS gross_daily_revenue,
    CAST(sum(win_amount) AS DOUBLE) AS daily_payout,
    CAST(sum(-net_result) AS DOUBLE) AS daily_ggr,
    count(transaction_id) AS total_bets, count(DISTINCT player_id) AS active_players,
    CAST(sum(bet_amount) AS DOUBLE) AS total_wagered, CAST(sum(win_amount) AS DOUBLE) AS total_won,
    CAST(sum(net_result) AS DOUBLE) AS gross_gaming_revenue,
    count(DISTINCT session_id) AS total_sessions,
    coalesce({div("sum(-net_result)", "sum(bet_amount)")}, 0) * 100 AS hold_percentage,
    coalesce({div("sum(bet_amount)", "count(*)")}, 0) AS avg_bet_size,
    coalesce({div("count(*)", "count(DISTINCT player_id)")}, 0) AS bets_per_player,
    m.type AS game_type, m.rtp AS theoretical_rtp, m.volatility, m.visual_engagement
  FROM bets t JOIN games m ON t.game_id = m.game_id LEFT JOIN growth g ON t.date = g.date
  GROUP BY t.date, t.game_id, m.type, m.rtp, m.volatility, m.visual_engagement
)""",
)
DAILY_DOUBLES = (
    "gross_daily_revenue daily_payout daily_ggr total_wagered total_won gross_gaming_revenue "
    "hold_percentage avg_bet_size bets_per_player theoretical_rtp visual_engagement"
)

LAGS = """
  lag(daily_ggr, 1) OVER g AS ggr_lag1, lag(daily_ggr, 7) OVER g AS ggr_lag7,
  lag(daily_ggr, 30) OVER g AS ggr_lag30,
  lag(total_wagered, 1) OVER g AS revenue_lag1, lag(total_wagered, 7) OVER g AS revenue_lag7,
  lag(total_wagered, 30) OVER g AS revenue_lag30,
  lag(daily_active_users, 1) OVER g AS dau_lag1, lag(daily_active_users, 7) OVER g AS dau_lag7,
  lag(total_bets, 7) OVER g AS bets_lag7, lag(cumulative_player_base, 7) OVER g AS player_base_lag7"""
LAG_DOUBLES = "ggr_lag1 ggr_lag7 ggr_lag30 revenue_lag1 revenue_lag7 revenue_lag30"
MEANS = """
  avg(daily_ggr) OVER w7 AS ggr_ma7, avg(daily_ggr) OVER w30 AS ggr_ma30,
  avg(total_wagered) OVER w7 AS revenue_ma7, avg(total_wagered) OVER w30 AS revenue_ma30,
  avg(CAST(daily_active_users AS DOUBLE)) OVER w7 AS dau_ma7,
  avg(CAST(total_bets AS DOUBLE)) OVER w7 AS bets_ma7"""
MEAN_DOUBLES = "ggr_ma7 ggr_ma30 revenue_ma7 revenue_ma30 dau_ma7 bets_ma7"
SPREADS = """
  stddev_samp(daily_ggr) OVER w7 AS ggr_std7, stddev_samp(daily_ggr) OVER w30 AS ggr_std30,
  stddev_samp(total_wagered) OVER w7 AS revenue_std7"""
SPREAD_DOUBLES = "ggr_std7 ggr_std30 revenue_std7"
SUMS = """
  sum(daily_ggr) OVER w7 AS ggr_sum7, sum(total_wagered) OVER w7 AS revenue_sum7"""
RANGE = """
  min(daily_ggr) OVER w7 AS ggr_min7, max(daily_ggr) OVER w7 AS ggr_max7,
  coalesce(max(daily_ggr) OVER w7 - min(daily_ggr) OVER w7, 0) AS ggr_range7"""
FRAMES = """
  WINDOW g AS (PARTITION BY game_id ORDER BY date),
  w7 AS (PARTITION BY game_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
  w30 AS (PARTITION BY game_id ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""


def _change(now: str, then: str) -> str:
    return (
        f"CASE WHEN {then} IS NULL OR {then} = 0 THEN 0 "
        f"ELSE CAST({now} - {then} AS DOUBLE) / abs(CAST({then} AS DOUBLE)) END"
    )


GROWTH = f"""
  {_change("daily_ggr", "ggr_lag7")} AS ggr_growth_7d,
  {_change("daily_ggr", "ggr_lag30")} AS ggr_growth_30d,
  {_change("total_wagered", "revenue_lag7")} AS revenue_growth_7d,
  {_change("daily_active_users", "dau_lag7")} AS dau_growth_7d,
  {_change("cumulative_player_base", "player_base_lag7")} AS player_growth_7d"""
GROWTH_DOUBLES = (
    "ggr_growth_7d ggr_growth_30d revenue_growth_7d dau_growth_7d player_growth_7d"
)
RATIOS = f"""
  coalesce({div("daily_ggr", "daily_active_users")}, 0) AS ggr_per_player,
  coalesce({div("total_wagered", "daily_active_users")}, 0) AS revenue_per_player,
  coalesce({div("total_bets", "total_sessions")}, 0) AS bets_per_session,
  CASE WHEN theoretical_rtp = 0 THEN 0
    ELSE hold_percentage / nullif(100 * (1 - theoretical_rtp), 0) END AS hold_vs_expected"""
RATIO_DOUBLES = "ggr_per_player revenue_per_player bets_per_session hold_vs_expected"
CALENDAR = """
  CAST(date - min(date) OVER () AS INTEGER) AS days_from_launch,
  CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  CAST(day(date) AS INTEGER) AS day_of_month, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
  CAST(weekofyear(date) AS INTEGER) AS week_of_year,
  CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN day(date) IN (1,2,3) THEN 1 ELSE 0 END AS is_month_start,
  CASE WHEN day(date) IN (14,15,16,17) THEN 1 ELSE 0 END AS is_month_mid"""


def _windowed(cols: str, doubles: str) -> str:
    return twin(DAILY, f"SELECT date, game_id, {cols} FROM daily {FRAMES}", doubles)


def _platform(source: str) -> str:
    return f"""SELECT date, count(transaction_id) AS total_bets,
    count(DISTINCT player_id) AS active_players, sum(bet_amount) AS total_wagered,
    sum(win_amount) AS total_won, sum(net_result) AS gross_gaming_revenue,
    count(DISTINCT session_id) AS total_sessions,
    {div("-sum(net_result)", "sum(bet_amount)")} * 100 AS hold_percentage,
    {div("sum(bet_amount)", "count(*)")} AS avg_bet_size,
    {div("count(*)", "count(DISTINCT player_id)")} AS bets_per_player
    FROM {source} GROUP BY date"""


PLATFORM_DOUBLES = (
    "total_wagered total_won gross_gaming_revenue hold_percentage avg_bet_size bets_per_player"
)
KPI_DOUBLES = (
    "total_ggr total_wagered avg_hold avg_daily_users wagered_per_day bets_per_day"
)

SQL = {
    "first_appearance": twin(
        BETS, "SELECT player_id, min(date) AS first_play_date FROM bets GROUP BY player_id"
    ),
    "platform_growth": twin(join(BETS, growth("bets")), "SELECT * FROM growth"),
    "ledger_platform_growth": twin(join(LEDGER, growth("ledger")), "SELECT * FROM growth"),
    "daily_game_aggregate": twin(DAILY, "SELECT * FROM daily", DAILY_DOUBLES),
    "daily_game_aggregate_carried": twin(
        DAILY,
        """SELECT d.date, d.game_id, CAST((SELECT max(cumulative_player_base) FROM growth g
        WHERE g.date <= d.date) AS BIGINT) AS cumulative_player_base FROM daily d""",
    ),
    "lag_features": _windowed(LAGS, LAG_DOUBLES),
    "moving_averages": _windowed(MEANS, MEAN_DOUBLES),
    "moving_averages_full_windows": _windowed(
        """CASE WHEN count(*) OVER w7 >= 7 THEN avg(daily_ggr) OVER w7 END AS ggr_ma7,
        CASE WHEN count(*) OVER w7 >= 7 THEN avg(total_wagered) OVER w7 END AS revenue_ma7""",
        "ggr_ma7 revenue_ma7",
    ),
    "moving_deviations": _windowed(SPREADS, SPREAD_DOUBLES),
    "moving_sums": _windowed(SUMS, "ggr_sum7 revenue_sum7"),
    "moving_range": _windowed(RANGE, "ggr_min7 ggr_max7 ggr_range7"),
    "growth_rates": twin(
        join(DAILY, f"\nlagged AS (SELECT *, {LAGS} FROM daily {FRAMES})"),
        f"SELECT date, game_id, {GROWTH} FROM lagged",
        GROWTH_DOUBLES,
    ),
    "interaction_ratios": twin(
        DAILY, f"SELECT date, game_id, {RATIOS} FROM daily", RATIO_DOUBLES
    ),
    "volatility_ratio": twin(
        join(DAILY, f"\naveraged AS (SELECT *, {MEANS} FROM daily {FRAMES})"),
        f"""SELECT date, game_id, coalesce({div("daily_ggr", "ggr_ma7")}, 0) AS ggr_vs_ma7_ratio
        FROM averaged""",
        "ggr_vs_ma7_ratio",
    ),
    "daily_features": twin(
        join(
            DAILY,
            f"""
wide AS (
  SELECT *, {CALENDAR}, {LAGS}, {MEANS}, {SPREADS}, {SUMS}, {RANGE} FROM daily {FRAMES}
)""",
        ),
        f"""SELECT *, {GROWTH}, {RATIOS},
        coalesce({div("daily_ggr", "ggr_ma7")}, 0) AS ggr_vs_ma7_ratio FROM wide""",
        " ".join(
            [
                DAILY_DOUBLES, LAG_DOUBLES, MEAN_DOUBLES, SPREAD_DOUBLES, "ggr_sum7 revenue_sum7",
                "ggr_min7 ggr_max7 ggr_range7", GROWTH_DOUBLES, RATIO_DOUBLES, "ggr_vs_ma7_ratio",
            ]
        ),
    ),
    "platform_summary": twin(BETS, _platform("bets"), PLATFORM_DOUBLES),
    "ledger_platform_summary": twin(LEDGER, _platform("ledger"), PLATFORM_DOUBLES),
    "kpi_strip": twin(
        DAILY,
        f"""SELECT -sum(gross_gaming_revenue) AS total_ggr, sum(total_wagered) AS total_wagered,
        CAST(sum(total_bets) AS BIGINT) AS total_bets, avg(hold_percentage) AS avg_hold,
        count(DISTINCT date) AS unique_days, {mean("daily_active_users")} AS avg_daily_users,
        {div("sum(total_wagered)", "count(DISTINCT date)")} AS wagered_per_day,
        {div("sum(total_bets)", "count(DISTINCT date)")} AS bets_per_day
        FROM daily WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""",
        KPI_DOUBLES,
    ),
    "daily_ggr_trend": twin(
        join(
            DAILY,
            """
by_day AS (
  SELECT date, -sum(gross_gaming_revenue) AS ggr, sum(total_wagered) AS total_wagered,
    CAST(sum(total_bets) AS BIGINT) AS total_bets,
    CAST(sum(daily_active_users) AS BIGINT) AS daily_active_users
  FROM daily GROUP BY date
)""",
        ),
        """SELECT *, CASE WHEN count(*) OVER w >= 7 THEN avg(ggr) OVER w END AS ma7 FROM by_day
        WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
        "ggr total_wagered ma7",
    ),
    "wagering_by_game": twin(
        DAILY,
        """SELECT game_id, game_name, sum(total_wagered) AS total_wagered,
        sum(total_wagered) * 100 / sum(sum(total_wagered)) OVER () AS pct_of_total
        FROM daily LEFT JOIN games USING (game_id) GROUP BY 1, 2""",
        "total_wagered pct_of_total",
    ),
    "hold_by_game_and_day": twin(
        DAILY,
        """SELECT game_id, date, avg(hold_percentage) AS hold_percentage FROM daily
        GROUP BY 1, 2""",
        "hold_percentage",
    ),
    "game_comparison": twin(
        DAILY,
        f"""SELECT game_id, game_name, sum(total_wagered) AS total_wagered,
        CAST(sum(total_bets) AS BIGINT) AS total_bets, avg(hold_percentage) AS hold_percentage,
        avg(avg_bet_size) AS avg_bet_size, {mean("daily_active_users")} AS daily_active_users,
        sum(total_wagered) / max(sum(total_wagered)) OVER () AS relative_size
        FROM daily LEFT JOIN games USING (game_id) GROUP BY 1, 2""",
        "total_wagered hold_percentage avg_bet_size daily_active_users relative_size",
    ),
    "type_comparison": twin(
        DAILY,
        """SELECT game_type, sum(total_wagered) AS total_wagered,
        CAST(sum(total_bets) AS BIGINT) AS total_bets, avg(hold_percentage) AS hold_percentage
        FROM daily GROUP BY game_type""",
        "total_wagered hold_percentage",
    ),
}
