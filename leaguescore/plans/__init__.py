"""Dimensions, scored stats, rosters and the report."""
