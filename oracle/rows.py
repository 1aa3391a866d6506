"""Twins of the row-level queries."""

from oracle.common import (
    BETS,
    GAMES,
    LEDGER,
    div,
    join,
    mean,
    sequence,
    twin,
)

BETS_SEQ = join(BETS, sequence("bets"))

SQL = {
    "calendar_columns": twin(
        BETS,
        """SELECT transaction_id, hour, day_of_week, day_of_month, month, is_weekend,
        is_peak_hour, is_payday, date FROM bets""",
    ),
    "ledger_calendar_paydays": twin(
        LEDGER,
        """SELECT CASE WHEN day_of_month IN (1,2,3,15,16,17) THEN 1 ELSE 0 END AS is_payday,
        is_weekend, CASE WHEN hour BETWEEN 18 AND 23 THEN 1 ELSE 0 END AS is_peak_hour,
        count(*) AS n, sum(net_result) AS net FROM ledger GROUP BY 1, 2, 3""",
        "net",
    ),
    "temporal_features": twin(
        LEDGER,
        """SELECT date, count(*) AS bets,
        CAST(date - (SELECT min(date) FROM ledger) AS INTEGER) AS days_from_launch,
        CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
        CAST(day(date) AS INTEGER) AS day_of_month,
        CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
        CAST(weekofyear(date) AS INTEGER) AS week_of_year,
        CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
        CASE WHEN day(date) IN (1,2,3) THEN 1 ELSE 0 END AS is_month_start,
        CASE WHEN day(date) IN (14,15,16,17) THEN 1 ELSE 0 END AS is_month_mid
        FROM ledger GROUP BY date""",
    ),
    "net_result": twin(
        BETS,
        "SELECT transaction_id, bet_amount, win_amount, net_result, session_id FROM bets",
        "bet_amount win_amount net_result",
    ),
    "running_balance": twin(
        BETS_SEQ,
        "SELECT transaction_id, session_id, session_balance FROM bets_seq",
        "session_balance",
    ),
    "ledger_running_balance": twin(
        join(LEDGER, sequence("ledger")),
        "SELECT transaction_id, session_id, session_balance FROM ledger_seq",
        "session_balance",
    ),
    "streak_lengths": twin(
        BETS_SEQ, "SELECT transaction_id, consecutive_losses, consecutive_wins FROM bets_seq"
    ),
    "player_streak_lengths": twin(
        join(
            BETS,
            "\nwhole AS (SELECT * REPLACE ('all' AS session_id) FROM bets)",
            sequence("whole"),
        ),
        "SELECT transaction_id, consecutive_losses, consecutive_wins FROM whole_seq",
    ),
    "previous_bets": twin(
        BETS,
        """SELECT transaction_id,
        lag(bet_amount) OVER w AS prev_bet, lag(net_result) OVER w AS prev_net FROM bets
        WINDOW w AS (PARTITION BY player_id, session_id ORDER BY "timestamp", transaction_id)""",
        "prev_bet prev_net",
    ),
    "win_multipliers": twin(
        BETS,
        f"""SELECT transaction_id, {div("win_amount", "bet_amount")} AS multiplier
        FROM bets WHERE win_amount > 0""",
        "multiplier",
    ),
    "winsorised_bets": twin(
        BETS,
        """SELECT transaction_id, greatest(least(CAST(bet_amount AS DOUBLE), hi), lo)
        AS bet_amount_clipped FROM bets, (SELECT quantile_cont(CAST(bet_amount AS DOUBLE), 0.01) AS lo,
        quantile_cont(CAST(bet_amount AS DOUBLE), 0.99) AS hi FROM bets)""",
        "bet_amount_clipped",
    ),
    "exact_bet_quantiles": twin(
        LEDGER,
        """SELECT game_id, quantile_cont(CAST(bet_amount AS DOUBLE), 0.01) AS p01,
        quantile_cont(CAST(bet_amount AS DOUBLE), 0.5) AS p50,
        quantile_cont(CAST(bet_amount AS DOUBLE), 0.99) AS p99 FROM ledger GROUP BY game_id""",
        "p01 p50 p99",
    ),
    "week_starts": twin(
        LEDGER,
        """SELECT CAST(date_trunc('week', "timestamp") AS DATE) AS week_start, count(*) AS bets
        FROM ledger GROUP BY 1""",
    ),
    "month_abbreviations": twin(
        LEDGER,
        """SELECT month, strftime(make_date(2000, month, 1), '%b') AS month_abbr, count(*) AS bets
        FROM ledger GROUP BY month""",
    ),
    "cohort_indexes": twin(
        LEDGER,
        """SELECT CAST(date_diff('month', cohort, date_trunc('month', date)) AS INTEGER) AS calendar_index,
        CAST(floor(date_diff('day', CAST(cohort AS DATE), CAST(date_trunc('month', date) AS DATE))
          / CAST(30.44 AS DOUBLE)) AS INTEGER) AS months_since_acquisition, count(*) AS bets
        FROM ledger JOIN (SELECT player_id, date_trunc('month', min(date)) AS cohort
          FROM ledger GROUP BY player_id) USING (player_id) GROUP BY 1, 2""",
    ),
    "game_names": twin(
        join(BETS, GAMES),
        """SELECT game_id, game_name, count(*) AS bets FROM bets LEFT JOIN games USING (game_id)
        GROUP BY 1, 2""",
    ),
    "game_types": twin(
        join(BETS, GAMES),
        """SELECT game_id, type, count(*) AS bets FROM bets LEFT JOIN games USING (game_id)
        GROUP BY 1, 2""",
    ),
    "look_back_rows": twin(
        LEDGER,
        """SELECT date, count(*) AS bets FROM ledger
        WHERE date >= (SELECT max(date) FROM ledger) - 90 GROUP BY date""",
    ),
    "minimum_activity": twin(
        BETS,
        """SELECT player_id, count(*) AS total_bets, count(DISTINCT date) AS active_days
        FROM bets GROUP BY 1 HAVING count(*) >= 10 AND count(DISTINCT date) >= 2""",
    ),
    "date_range": twin(
        LEDGER,
        f"""SELECT date, count(*) AS bets, {mean("bet_amount")} AS avg_bet FROM ledger
        WHERE date BETWEEN DATE '1996-03-01' AND DATE '1996-03-31' GROUP BY date""",
        "avg_bet",
    ),
    "string_predicates": twin(
        BETS,
        """SELECT count(*) FILTER (game_id LIKE 'G001%') AS slots,
        count(*) FILTER (game_id LIKE 'G002%') AS tables,
        count(*) FILTER (game_id LIKE '%00%') AS known FROM bets""",
    ),
    "stable_sample": twin(
        BETS,
        """SELECT transaction_id, bet_amount FROM bets
        WHERE CAST('0x' || substr(md5(CAST(transaction_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 10""",
        "bet_amount",
    ),
    "filled_features": twin(
        BETS,
        f"""SELECT player_id, coalesce(stddev_samp(CAST(bet_amount AS DOUBLE)), 0) AS bet_volatility,
        coalesce({div("-sum(net_result)",
            "floor(epoch(max(\"timestamp\") - min(\"timestamp\")) / 86400) + 1")}, 0)
          AS avg_daily_value
        FROM bets GROUP BY player_id""",
        "bet_volatility avg_daily_value",
    ),
    "ggr_definitions": twin(
        BETS,
        """SELECT game_id, -sum(net_result) AS ggr_house,
        abs(sum(CASE WHEN net_result < 0 THEN net_result ELSE 0 END)) AS ggr_losses,
        abs(sum(net_result)) AS ggr_absolute, sum(net_result) AS ggr_player,
        CASE WHEN sum(net_result) < 0 THEN abs(sum(net_result)) ELSE 0 END AS ggr_house_or_zero
        FROM bets GROUP BY game_id""",
        "ggr_house ggr_losses ggr_absolute ggr_player ggr_house_or_zero",
    ),
}
