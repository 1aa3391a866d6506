"""Shared intermediates and end-to-end compositions."""
