"""Reusable DataFrame operators: fused counts, key profiles, lookups, sampling."""
