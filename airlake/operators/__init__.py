"""Reusable DataFrame -> DataFrame operators (dedupe, grids, windows, medians, joins, checks)."""
