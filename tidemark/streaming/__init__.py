"""Structured Streaming pieces: the replay-safe ledger sink and its read views,
running counters, and running queries with per-query state settings."""
