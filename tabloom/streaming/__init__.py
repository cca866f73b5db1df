"""Streaming operators."""

from tabloom.streaming.dedupe import dedupe_stream, drain

__all__ = ["dedupe_stream", "drain"]
