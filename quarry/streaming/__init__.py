"""Structured Streaming jobs: per-batch statistics, keyed state, online models."""
