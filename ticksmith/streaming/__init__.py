"""Structured Streaming jobs: watermarks, checkpoints, triggers, fan-out."""
