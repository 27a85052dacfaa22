"""Reusable DataFrame operators: one row per key, skew-aware joins, dimension lookups, document operations."""
