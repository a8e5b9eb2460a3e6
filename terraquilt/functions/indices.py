"""Spectral indices as column expressions over a wide pixel table."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from terraquilt.functions.maths import EPSILON, clamp, safe_ratio

# Band numbers of the six inputs per sensor.
BAND_MAPS = {
    "landsat_8": {"red": 1, "blue": 2, "green": 3, "nir": 4, "swir16": 5, "swir22": 6},
    "sentinel_2": {"red": 4, "blue": 2, "green": 3, "nir": 8, "swir16": 11, "swir22": 12},
}

# Output order.
INDEX_NAMES = (
    "ndvi", "evi", "savi", "gndvi", "arvi", "msavi", "ndwi", "awei_nsh", "awei_sh",
    "ndsi", "nbr", "si", "ndbi", "ui", "ibi", "albedo",
)


def normalised_difference(a: Column, b: Column, epsilon: float = EPSILON) -> Column:
    """(a - b) / (a + b), limited to [-1, 1]."""
    return clamp(safe_ratio(a - b, a + b, epsilon), -1, 1)


def spectral_indices(bands: dict[str, Column]) -> dict[str, Column]:
    """Name to expression for all 16 indices; inputs are widened to DOUBLE first."""
    red, blue, green, nir, swir16, swir22 = (
        bands[name].cast("double") for name in ("red", "blue", "green", "nir", "swir16", "swir22")
    )
    root = F.greatest((nir * 2 + 1) * (nir * 2 + 1) - (nir - red) * 8, F.lit(0.0))
    red_blue = red - (blue - red)
    savi = clamp(safe_ratio((nir - red) * 1.5, nir + red + 0.5, EPSILON), -1.5, 1.5)
    ndbi = normalised_difference(swir16, nir)
    water_soil = savi + normalised_difference(green, swir16)
    reflected = blue * 0.356 + red * 0.130 + nir * 0.373 + swir16 * 0.085 + swir22 * 0.072 - 0.018
    return {
        "ndvi": normalised_difference(nir, red, 0.0),
        "evi": clamp(safe_ratio((nir - red) * 2.5, nir + red * 6 - blue * 7.5 + 1, EPSILON), -1, 1),
        "savi": savi,
        "gndvi": normalised_difference(nir, green),
        "arvi": normalised_difference(nir, red_blue),
        "msavi": clamp((nir * 2 + 1 - F.sqrt(root)) / 2, 0, 1),
        "ndwi": normalised_difference(green, nir, 0.0),
        "awei_nsh": (green - swir16) * 4 - (nir * 0.25 + swir22 * 2.75),
        "awei_sh": green + nir * 2.5 - (swir16 + swir22) * 1.5 - blue * 0.25,
        "ndsi": normalised_difference(green, swir16),
        "nbr": normalised_difference(nir, swir22),
        "si": normalised_difference(swir16, blue),
        "ndbi": ndbi,
        "ui": normalised_difference(swir16, red),
        "ibi": clamp(safe_ratio(ndbi - water_soil, ndbi + water_soil, EPSILON), -1, 1),
        "albedo": clamp(reflected / 1.016, 0, 1),
    }
