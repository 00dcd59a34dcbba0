"""Structured Streaming wrappers."""

from kpiloom.streaming.incremental import start_incremental_load  # noqa: F401
