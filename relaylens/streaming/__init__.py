"""Structured Streaming operators."""

from . import ingest  # noqa: F401
