"""Reading bet logs, games and tables; writing result tables."""
