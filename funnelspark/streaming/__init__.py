"""Structured Streaming jobs: once-only file loading and incremental upserts."""
