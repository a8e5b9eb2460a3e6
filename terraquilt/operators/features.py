"""Building, street and zoning features: filters, casts and derived attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from terraquilt.config import STREET_COLUMNS, STREET_FEATURE_COLUMNS, STREET_NUMERIC_TEXT, JobConfig
from terraquilt.functions import crs, geometry as geo, maths, text

ENVELOPE = ("xmin", "ymin", "xmax", "ymax")


def project_if_present(df: DataFrame, names) -> DataFrame:
    return df.select([c for c in names if c in df.columns])


def project_rename(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select and rename in one step; ``columns`` maps input to output name."""
    return df.select(*[F.col(source).alias(target) for source, target in columns.items()])


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts that give NULL for unreadable text."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def drop_null_required(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(how="any", subset=columns)


def exclude_ids(df: DataFrame, column: str, ids: list) -> DataFrame:
    return df.where(~F.col(column).isin(ids))


def not_in(value: Column, excluded, null_policy: str = "drop") -> Column:
    """``NOT IN``; a NULL value is dropped (SQL rule) or kept."""
    if null_policy not in ("drop", "keep"):
        raise ValueError("null_policy is 'drop' or 'keep'")
    outside = ~value.isin(*excluded)
    return F.coalesce(outside, F.lit(True)) if null_policy == "keep" else outside


def before_timestamp(value: Column, limit: str) -> Column:
    """Timestamp text strictly before a date; unreadable text is not before anything."""
    return F.try_to_timestamp(value) < F.lit(limit).cast("timestamp")


# ---------------------------------------------------------------- study area

def with_envelope(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Bounding box as four columns; stored in Parquet they let a scan skip row groups."""
    kept = [c for c in df.columns if c not in ENVELOPE]
    return df.select(*kept, F.expr(f"inline(array({geo.envelope(geometry)}))"))


def _enveloped(df: DataFrame, geometry: str) -> DataFrame:
    return df if set(ENVELOPE) <= set(df.columns) else with_envelope(df, geometry)


def bbox_contains(df: DataFrame, bbox, geometry: str = "geometry") -> DataFrame:
    """Shapes inside the rectangle; one that only runs along its border is not inside."""
    x0, y0, x1, y1 = (geo.number(v) for v in bbox)
    inside = f"xmin >= {x0} AND xmax <= {x1} AND ymin >= {y0} AND ymax <= {y1}"
    strict = f"xmin > {x0} AND xmax < {x1} AND ymin > {y0} AND ymax < {y1}"
    # an edge within a closed rectangle has inner points exactly if its midpoint is one
    inner_edge = (
        f"exists({geo.geometry_edges(geometry)}, e_ -> e_.x1 + e_.x2 > 2 * {x0} AND e_.x1 + e_.x2 < 2 * {x1} "
        f"AND e_.y1 + e_.y2 > 2 * {y0} AND e_.y1 + e_.y2 < 2 * {y1})"
    )
    solid = f"{geometry}.type = 'Polygon' OR ({strict}) OR {inner_edge}"
    return _enveloped(df, geometry).where(inside).where(solid).select(*df.columns)


def bbox_intersects(df: DataFrame, bbox, geometry: str = "geometry") -> DataFrame:
    """Shapes that share at least a point with the closed rectangle."""
    x0, y0, x1, y1 = box = tuple(geo.number(v) for v in bbox)
    overlap = f"xmin <= {x1} AND xmax >= {x0} AND ymin <= {y1} AND ymax >= {y0}"
    exact = geo.box_intersects(f"{geometry}.type", geo.geometry_edges(geometry), box)
    return _enveloped(df, geometry).where(overlap).where(exact).select(*df.columns)


def bbox_midpoint(df: DataFrame, bbox, geometry: str = "geometry") -> DataFrame:
    """Polygons whose midpoint of shell vertices 0 and 2 lies strictly inside the rectangle."""
    x0, y0, x1, y1 = (geo.number(v) for v in bbox)
    shell = f"get(get({geometry}.parts, 0), 0)"
    x, y = (f"(get({shell}, 0).{axis} + get({shell}, 2).{axis}) / 2" for axis in "xy")
    return df.where(
        f"{geometry}.type = 'Polygon' AND {x} > {x0} AND {x} < {x1} AND {y} > {y0} AND {y} < {y1}"
    )


BBOX_PREDICATES = {"contains": bbox_contains, "intersects": bbox_intersects, "midpoint": bbox_midpoint}


# ---------------------------------------------------------------- measures

def polygon_area_sqft(geometry: str = "geometry") -> Column:
    """Planar area in square feet of EPSG:2263."""
    return F.expr(geo.parts_area(geo.transform_parts(f"{geometry}.parts", crs.vertices_to_state_plane)))


def line_length_ft(geometry: str = "geometry") -> Column:
    """Planar length in US survey feet of EPSG:2263."""
    return F.expr(geo.parts_length(geo.transform_parts(f"{geometry}.parts", crs.vertices_to_state_plane)))


def with_line_length(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    feet = df.withColumn("length_ft", line_length_ft(geometry))
    return feet.withColumn("length_m", F.col("length_ft") * F.lit(crs.US_FOOT_M))


def area_threshold(df: DataFrame, minimum: float, column: str = "shape_area") -> DataFrame:
    return df.where(F.col(column) >= minimum)


# ---------------------------------------------------------------- buildings

# Types of the building columns, all delivered as text.
BUILDING_TYPES = {
    "bin": "int", "cnstrct_yr": "int", "heightroof": "double", "feat_code": "int",
    "base_bbl": "string", "mpluto_bbl": "string",
}


def building_attr_filter(df: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    """Existing, tall enough buildings of the wanted boroughs, as of the cut-off date."""
    return df.where(
        (F.col("cnstrct_yr") <= cfg.max_year)
        & F.expr("bin div 1000000").isin(*cfg.boroughs)
        & (F.col("heightroof") >= cfg.min_height_ft)
        & F.col("feat_code").isin(*cfg.building_codes)
        & (F.col("lstmoddate") < F.lit(cfg.modified_before).cast("timestamp"))
        & (F.col("lststatype") == cfg.building_status)
    )


def filter_buildings(raw: DataFrame, cfg: JobConfig = JobConfig(), predicate: str = "intersects") -> DataFrame:
    """Raw text records (``the_geom`` in the normal form) to filtered buildings with ``shape_area``."""
    required = drop_null_required(raw, ["the_geom", "bin", "cnstrct_yr", "heightroof"])
    typed = cast_columns(required.withColumnRenamed("the_geom", "geometry"), BUILDING_TYPES).withColumn(
        "lstmoddate", F.try_to_timestamp("lstmoddate")
    )
    local = BBOX_PREDICATES[predicate](building_attr_filter(typed, cfg), cfg.bbox)
    area = F.inline(F.array(F.struct(polygon_area_sqft().alias("shape_area"))))
    return area_threshold(local.select("*", area), cfg.min_area_sqft)


def building_features(buildings: DataFrame) -> DataFrame:
    return buildings.select(
        "bin", "cnstrct_yr", "heightroof", "shape_area", "geometry", "base_bbl", "mpluto_bbl"
    )


# ---------------------------------------------------------------- streets

def street_attr_filter(df: DataFrame, cfg: JobConfig = JobConfig(), null_policy: str = "drop") -> DataFrame:
    """Built, real, street-like segments with a geometry; ``RW_TYPE`` is trimmed on the way."""
    trimmed = df.withColumn("RW_TYPE", F.trim("RW_TYPE"))
    return trimmed.where(
        not_in(F.col("FeatureTyp"), cfg.drop_feature_types, null_policy)
        & not_in(F.col("SegmentTyp"), cfg.drop_segment_types, null_policy)
        & not_in(F.col("RW_TYPE"), cfg.drop_roadway_types, null_policy)
        & (F.col("Status") == cfg.street_status)
        & F.col("geometry").isNotNull()
    )


def filter_streets(
    raw: DataFrame, cfg: JobConfig = JobConfig(), predicate: str = "intersects", null_policy: str = "drop"
) -> DataFrame:
    kept = project_if_present(street_attr_filter(raw, cfg, null_policy), STREET_COLUMNS)
    typed = cast_columns(
        kept, {"StreetWidth_Min": "int", "StreetWidth_Max": "int", "Shape__Length": "double"}
    )
    return with_line_length(BBOX_PREDICATES[predicate](typed, cfg.bbox))


def street_features(streets: DataFrame) -> DataFrame:
    """Numbers out of padded text, mean width and compass direction of each segment."""
    numbers = {c: text.text_to_double(F.col(c)) for c in STREET_NUMERIC_TEXT if c in streets.columns}
    if "RW_TYPE" in numbers:
        numbers["RW_TYPE"] = numbers["RW_TYPE"].cast("int")
    if "BIKE_TRAFDIR" in streets.columns:
        numbers["BIKE_TRAFDIR"] = text.blank_to_null(F.col("BIKE_TRAFDIR"))
    start = F.expr(crs.from_state_plane("XFrom", "YFrom"))
    end = F.expr(crs.from_state_plane("XTo", "YTo"))
    placed = streets.withColumns(numbers).withColumns({"_start": start, "_end": end})
    derived = placed.withColumns({
        "street_width_avg": maths.mean_of_two(F.col("StreetWidth_Min"), F.col("StreetWidth_Max")),
        "direction": maths.bearing_class(
            F.col("_end.lon") - F.col("_start.lon"), F.col("_end.lat") - F.col("_start.lat")
        ),
    })
    return project_if_present(derived, STREET_FEATURE_COLUMNS)


# ---------------------------------------------------------------- zoning

def filter_zoning(raw: DataFrame, cfg: JobConfig = JobConfig(), predicate: str = "intersects") -> DataFrame:
    typed = cast_columns(raw, {"Shape__Area": "double", "Shape__Length": "double"})
    return BBOX_PREDICATES[predicate](typed.where(F.col("geometry").isNotNull()), cfg.bbox)


def zoning_levels(df: DataFrame) -> DataFrame:
    """District code at three levels: whole, before the dash, first letter."""
    return df.withColumnRenamed("ZONEDIST", "zonedist_level3").withColumns({
        "zonedist_level2": text.level_before_dash(F.col("zonedist_level3")),
        "zonedist_level1": text.first_letter(F.col("zonedist_level3")),
    })


def overlay_levels(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("OVERLAY", "overlay_level2").withColumn(
        "overlay_level1", text.level_before_dash(F.col("overlay_level2"))
    )


def special_district_levels(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("SDLBL", "sd_level2").withColumn(
        "sd_level1", text.level_before_dash(F.col("sd_level2"))
    )
