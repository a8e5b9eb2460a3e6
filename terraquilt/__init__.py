"""Spark-native operators for environmental trend and urban-climate feature work."""

from terraquilt.config import JobConfig
from terraquilt.grid import GridSpec

__all__ = ["GridSpec", "JobConfig"]
