"""Composed plans: marts, read queries, the daily batch."""
