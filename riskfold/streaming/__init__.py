"""Structured Streaming scoring (stateless; no watermark needed)."""

from riskfold.streaming.score_stream import read_committed, start_scoring_stream

__all__ = ["read_committed", "start_scoring_stream"]
