"""Grouping entities into jobs."""
