"""Structured Streaming: per-batch router, stateful rules, replay source."""
