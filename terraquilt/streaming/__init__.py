"""Incremental processing. The feature job has no event streams; it grows by new inputs."""

from terraquilt.streaming.incremental import skip_existing

__all__ = ["skip_existing"]
