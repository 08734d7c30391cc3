"""Logical plans: Silver, the Gold tables, the serving queries and the quality profile."""
