"""Twins of the source and sink queries: the tables they write and read back."""

from oracle.common import BETS, GAMES, LEDGER, MARKET, div, join, sequence, twin
from oracle.daily import DAILY

SQL = {
    "games_from_csv": twin(
        join(BETS, GAMES),
        """SELECT games.*, bets FROM games LEFT JOIN
        (SELECT game_id, count(*) AS bets FROM bets GROUP BY 1) USING (game_id)""",
        "rtp min_bet hit_frequency max_multiplier bonus_frequency visual_engagement",
    ),
    "month_export_reload": twin(
        join(BETS, sequence("bets")),
        """SELECT CAST(player_id AS VARCHAR) AS player_id, count(*) AS bets,
        sum(bet_amount) AS wagered, sum(session_balance) AS balances,
        max(consecutive_losses) AS longest, max("timestamp") AS last_bet, min(date) AS first_day
        FROM bets_seq GROUP BY 1""",
        "wagered balances",
    ),
    "month_files": twin(
        LEDGER,
        """SELECT strftime("timestamp", '%Y-%m') AS month, count(*) AS bets FROM ledger
        GROUP BY 1""",
    ),
    "incremental_ingest": twin(
        BETS,
        "SELECT game_id, count(*) AS bets, sum(net_result) AS net FROM bets GROUP BY 1",
        "net",
    ),
    "table_round_trip": twin(
        DAILY, "SELECT date, game_id, total_bets, daily_ggr FROM daily", "daily_ggr"
    ),
    "daily_export_kpis": twin(
        DAILY,
        f"""SELECT sum(daily_ggr) AS total_ggr, sum(total_wagered) AS total_wagered,
        CAST(sum(total_bets) AS DOUBLE) AS total_bets, avg(hold_percentage) AS avg_hold,
        count(DISTINCT date) AS unique_days, CAST(100 AS DOUBLE) AS avg_daily_users,
        {div("sum(total_wagered)", "count(DISTINCT date)")} AS wagered_per_day,
        {div("sum(total_bets)", "count(DISTINCT date)")} AS bets_per_day FROM daily""",
        "total_ggr total_wagered total_bets avg_hold wagered_per_day bets_per_day",
    ),
    "run_statistics": twin(
        join(
            LEDGER,
            MARKET,
            """
flags AS (
  SELECT player_id, (SELECT max(date) FROM ledger) - max(date) > 60 AS gone
  FROM ledger GROUP BY player_id
),
gone_by AS (
  SELECT player_segment, count(*) AS n FROM flags JOIN market USING (player_id) WHERE gone
  GROUP BY 1
)""",
        ),
        f"""SELECT (SELECT count(*) FROM flags) AS total_players, count(*) AS total_transactions,
        sum(bet_amount) AS total_wagered, -sum(net_result) AS gross_gaming_revenue,
        (SELECT count(*) FROM flags WHERE gone) AS total_churned,
        {div("(SELECT count(*) FROM flags WHERE gone)", "(SELECT count(*) FROM flags)")}
          AS churn_rate,
        (SELECT '{{' || string_agg('"' || player_segment || '":' || n, ',' ORDER BY player_segment)
          || '}}' FROM gone_by) AS churn_by_segment
        FROM ledger""",
        "total_wagered gross_gaming_revenue churn_rate",
    ),
    "row_counts": twin(
        join(DAILY, LEDGER),
        """SELECT 'bets' AS "table", count(*) AS rows FROM bets UNION ALL
        SELECT 'ledger', count(*) FROM ledger UNION ALL SELECT 'daily', count(*) FROM daily""",
    ),
    "preview": twin(
        BETS,
        """SELECT transaction_id, player_id, game_id, bet_amount FROM bets
        ORDER BY "timestamp", transaction_id LIMIT 5""",
        "bet_amount",
    ),
    "bronze_load_report": twin(
        BETS,
        """SELECT 'bronze' AS "table", count(*) AS rows FROM bets UNION ALL
        SELECT 'silver', count(*) FROM bets UNION ALL
        SELECT 'rejects', 0 UNION ALL SELECT 'skipped_files', 1""",
    ),
    "rejected_rows": twin(
        BETS,
        """SELECT 'bronze' AS "table", count(*) AS rows FROM bets UNION ALL
        SELECT 'silver', count(*) FROM bets WHERE game_id <> 'G005' UNION ALL
        SELECT 'rejects', count(*) FROM bets WHERE game_id = 'G005'""",
    ),
    "dated_store_days": twin(
        BETS,
        "SELECT date, count(*) AS bets, sum(bet_amount) AS wagered, sum(net_result) AS net, "
        "count(DISTINCT player_id) AS players FROM bets GROUP BY date",
        "wagered net",
    ),
}
