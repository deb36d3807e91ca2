"""Structured Streaming jobs: job state (T1, T2), exactly-once claim and
dedup (T3), failure isolation (T4) and the catalogue upsert (S7)."""
