"""Sinks: schema contract, keyed idempotent append, message frames."""
