"""Job parameters. Everything that names a place, a date or a threshold lives here."""

from __future__ import annotations

from dataclasses import dataclass, field

from terraquilt.grid import GridSpec

# Street columns kept after filtering, where present.
STREET_COLUMNS = (
    "OBJECTID", "SegmentID", "Join_ID", "StreetCode", "Street", "TrafDir",
    "StreetWidth_Min", "StreetWidth_Max", "RW_TYPE", "POSTED_SPEED",
    "Number_Travel_Lanes", "Number_Park_Lanes", "Number_Total_Lanes",
    "FeatureTyp", "SegmentTyp", "BikeLane", "BIKE_TRAFDIR",
    "XFrom", "YFrom", "XTo", "YTo", "ArcCenterX", "ArcCenterY",
    "NodeIDFrom", "NodeIDTo", "NodeLevelF", "NodeLevelT",
    "TRUCK_ROUTE_TYPE", "Shape__Length", "geometry",
)

# Street columns of the derived feature table.
STREET_FEATURE_COLUMNS = (
    "OBJECTID", "Join_ID", "StreetCode", "Street", "TrafDir",
    "StreetWidth_Min", "StreetWidth_Max", "street_width_avg", "RW_TYPE",
    "POSTED_SPEED", "Number_Travel_Lanes", "Number_Park_Lanes",
    "Number_Total_Lanes", "FeatureTyp", "SegmentTyp", "BikeLane",
    "BIKE_TRAFDIR", "TRUCK_ROUTE_TYPE", "Shape__Length", "direction", "geometry",
)

# Padded text columns that hold numbers.
STREET_NUMERIC_TEXT = (
    "RW_TYPE", "Number_Travel_Lanes", "Number_Park_Lanes", "Number_Total_Lanes",
    "POSTED_SPEED", "BikeLane", "TRUCK_ROUTE_TYPE",
)

# Raster layers whose names ask for texture features.
TEXTURE_PREFIXES = (
    "landsat", "building", "street", "canopy", "aod", "population",
    "co", "hcho", "no2", "o3", "so2",
)

# Column layouts of the monthly series files.
SERIES_DDL = {
    "co2": "year INT, month INT, decimal_date DOUBLE, average DOUBLE, "
           "deseasonalized DOUBLE, ndays INT, sdev DOUBLE, unc DOUBLE",
    "ch4": "year INT, month INT, decimal DOUBLE, average DOUBLE, average_unc DOUBLE, "
           "trend DOUBLE, trend_unc DOUBLE",
    "n2o": "year INT, month INT, decimal DOUBLE, average DOUBLE, average_unc DOUBLE, "
           "trend DOUBLE, trend_unc DOUBLE",
    "sf6": "year INT, month INT, decimal DOUBLE, average DOUBLE, average_unc DOUBLE, "
           "trend DOUBLE, trend_unc DOUBLE",
}


@dataclass(frozen=True)
class JobConfig:
    """Study area, thresholds and input catalogue of one feature job. The thresholds are fixed values."""

    bbox: tuple[float, float, float, float] = (-74.01, 40.75, -73.86, 40.88)
    max_year: int = 2021
    modified_before: str = "2021-07-24"
    min_height_ft: float = 12.0
    min_area_sqft: float = 400.0
    boroughs: tuple[int, ...] = (1, 2)
    building_codes: tuple[int, ...] = (1006, 2100)
    building_status: str = "Constructed"
    drop_feature_types: tuple[str, ...] = ("2", "5", "7", "9", "F")
    drop_segment_types: tuple[str, ...] = ("G", "F")
    drop_roadway_types: tuple[str, ...] = ("4", "12", "14")
    street_status: str = "2"
    highway_type: int = 2
    window_sizes: tuple[int, ...] = (1, 2, 4, 7)
    catalogue: dict[str, str] = field(default_factory=dict)
    # raster inputs of the catalogue (pixel tables) and the grid each refers to
    grids: dict[str, GridSpec] = field(default_factory=dict)

    def path(self, name: str) -> str:
        """URI of a named input; any filesystem Spark can resolve."""
        try:
            return self.catalogue[name]
        except KeyError:
            raise KeyError(f"no input named {name!r}; known: {sorted(self.catalogue)}") from None
