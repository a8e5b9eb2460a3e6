"""Process only what has no output yet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def skip_existing(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``todo`` whose key is not in the manifest of finished outputs."""
    return todo.join(done.select(*keys), keys, "left_anti")
