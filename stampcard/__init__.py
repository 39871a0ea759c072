"""Stampcard: check-in rewards as Spark DataFrame and Structured Streaming jobs."""

from stampcard.config import EngineConfig, parse_points_sequence
from stampcard.session import tune

__all__ = ["EngineConfig", "parse_points_sequence", "tune"]
