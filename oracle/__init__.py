"""DuckDB twins of the registered queries, written independently of the Spark code."""

from __future__ import annotations

from oracle import daily, dashboards, lifecycle, players, rows, segments, sources

ORACLE: dict[str, str] = {}
for _module in (rows, daily, players, segments, dashboards, lifecycle, sources):
    ORACLE.update(_module.SQL)

# The same answers from the dated store as from the whole log.
ORACLE.update({f"{name}_dated": ORACLE[name] for name in ("segment_thresholds", "daily_by_segment", "game_preference")})
# The same answers from the activity bitmaps as from the active months.
ORACLE.update({f"{name}_bitmaps": ORACLE[name] for name in ("player_cohorts", "cohort_retention", "cohort_matrix")})
# The same answers when the log is sequenced in two loads with a carried state.
ORACLE.update({f"{name}_carried": ORACLE[name] for name in ("running_balance", "streak_lengths", "previous_bets")})
ORACLE["exact_bet_quantiles_radix"] = ORACLE["exact_bet_quantiles"]
