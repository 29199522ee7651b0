"""Triggered incremental jobs."""
