"""Operators by family: rows, daily, players, segments, clusters, dashboards, lifecycle."""
