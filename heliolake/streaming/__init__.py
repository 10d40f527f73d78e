"""Structured Streaming jobs: triggers, foreachBatch sinks, delivery policy, windows."""
