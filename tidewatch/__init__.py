"""Score transactions against risk rules, in batch and as a stream, on Spark."""

from tidewatch.config import RuleConfig, StreamConfig

__all__ = ["RuleConfig", "StreamConfig"]
