"""Relational patterns used by several plans: as-of join, interval cells, ranks, medians."""
