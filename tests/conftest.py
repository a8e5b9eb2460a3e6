import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from terraquilt.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def pixel_table(spark, array, raster_id="r", band=1, keep_nan=True):
    """Small NumPy grid to a pixel table."""
    rows = [
        (raster_id, band, i, j, float(v))
        for i, line in enumerate(array)
        for j, v in enumerate(line)
        if keep_nan or v == v
    ]
    return spark.createDataFrame(rows, "raster_id string, band int, row int, col int, value double")
