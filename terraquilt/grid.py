"""Raster geometry: the affine grid a pixel table refers to (row 0 is north)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from terraquilt.functions.geometry import number

METRES_PER_DEGREE = 111320.0


@dataclass(frozen=True)
class GridSpec:
    """North-up grid: west edge ``x0``, north edge ``y1``, cell size ``px`` x ``py``."""

    x0: float
    y1: float
    px: float
    py: float
    width: int
    height: int
    srid: int = 4326

    @classmethod
    def from_bbox(cls, bbox, resolution: float, srid: int = 4326) -> "GridSpec":
        west, south, east, north = bbox
        step = resolution / METRES_PER_DEGREE
        width = int(round((east - west) / step)) + 1
        height = int(round((north - south) / step)) + 1
        return cls(west, north, (east - west) / width, (north - south) / height, width, height, srid)

    @property
    def bbox(self):
        return (
            self.x0,
            self.y1 - self.height * self.py,
            self.x0 + self.width * self.px,
            self.y1,
        )

    # the following give Spark SQL expression text

    def col_of(self, x: str) -> str:
        return f"CAST(floor(({x} - {number(self.x0)}) / {number(self.px)}) AS INT)"

    def row_of(self, y: str) -> str:
        return f"CAST(floor(({number(self.y1)} - {y}) / {number(self.py)}) AS INT)"

    def centre_x(self, col: str) -> str:
        return f"({number(self.x0)} + ({col} + 0.5D) * {number(self.px)})"

    def centre_y(self, row: str) -> str:
        return f"({number(self.y1)} - ({row} + 0.5D) * {number(self.py)})"

    def box(self, row: str, col: str, rows: int = 1, cols: int = 1) -> tuple[str, str, str, str]:
        """Closed rectangle of a block of cells: ``xmin, ymin, xmax, ymax``."""
        x0, y1, px, py = number(self.x0), number(self.y1), number(self.px), number(self.py)
        return (
            f"({x0} + {col} * {px})",
            f"({y1} - ({row} + {rows}) * {py})",
            f"({x0} + ({col} + {cols}) * {px})",
            f"({y1} - {row} * {py})",
        )

    def cells(self, spark):
        """Every cell of the grid as ``(row, col)``, generated in parallel."""
        ids = spark.range(self.width * self.height)
        return ids.select(
            F.expr(f"CAST(id div {self.width} AS INT)").alias("row"),
            F.expr(f"CAST(id % {self.width} AS INT)").alias("col"),
        )


def grid_spec_columns(xmin: Column, ymin: Column, xmax: Column, ymax: Column, resolution: Column) -> dict[str, Column]:
    """Grid size as columns, for bounding boxes that are themselves data."""
    step = resolution / F.lit(METRES_PER_DEGREE)
    width = F.rint((xmax - xmin) / step).cast("int") + 1
    height = F.rint((ymax - ymin) / step).cast("int") + 1
    return {
        "width": width,
        "height": height,
        "px": (xmax - xmin) / width,
        "py": (ymax - ymin) / height,
    }
