"""Two-speed patient risk analytics expressed as Spark DataFrame jobs."""

from bedwatch.config import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Settings"]
