"""Coordinate transforms between the three reference systems in use.

EPSG:4326 (degrees), EPSG:2263 (Lambert conformal conic, US survey feet) and
EPSG:3857 (spherical web mercator). Formulas: Snyder, USGS Professional Paper 1395.

Functions take and return Spark SQL expression text, so that they nest inside the
higher-order functions of a geometry; wrap the outermost one in ``F.expr``.
"""

from __future__ import annotations

import math

# GRS80 ellipsoid and the parameters of EPSG:2263.
SEMI_MAJOR_M = 6378137.0
INVERSE_FLATTENING = 298.257222101
US_FOOT_M = 1200.0 / 3937.0
PARALLEL_1 = math.radians(41 + 2 / 60)
PARALLEL_2 = math.radians(40 + 40 / 60)
ORIGIN_LAT = math.radians(40 + 10 / 60)
ORIGIN_LON = math.radians(-74.0)
FALSE_EASTING_FT = 984250.0
FALSE_NORTHING_FT = 0.0

ECC = math.sqrt(2 / INVERSE_FLATTENING - 1 / INVERSE_FLATTENING**2)


def _cone_m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - (ECC * math.sin(phi)) ** 2)


def _isometric_t(phi: float) -> float:
    return math.tan(math.pi / 4 - phi / 2) * math.exp(ECC * math.atanh(ECC * math.sin(phi)))


CONE = (math.log(_cone_m(PARALLEL_1)) - math.log(_cone_m(PARALLEL_2))) / (
    math.log(_isometric_t(PARALLEL_1)) - math.log(_isometric_t(PARALLEL_2))
)
SCALE_FT = SEMI_MAJOR_M / US_FOOT_M * _cone_m(PARALLEL_1) / (CONE * _isometric_t(PARALLEL_1) ** CONE)
RHO_ORIGIN_FT = SCALE_FT * _isometric_t(ORIGIN_LAT) ** CONE


def _cone_radius(lat: str) -> str:
    phi = f"radians({lat})"
    t = f"tan(pi() / 4 - {phi} / 2) * exp({ECC!r}D * atanh({ECC!r}D * sin({phi})))"
    return f"({SCALE_FT!r}D * power({t}, {CONE!r}D))"


def _cone_angle(lon: str) -> str:
    return f"({CONE!r}D * (radians({lon}) - ({ORIGIN_LON!r}D)))"


def _from_cone(radius: str, angle: str) -> str:
    return (
        f"named_struct('x', {FALSE_EASTING_FT!r}D + {radius} * sin({angle}), "
        f"'y', {FALSE_NORTHING_FT + RHO_ORIGIN_FT!r}D - {radius} * cos({angle}))"
    )


def to_state_plane(lon: str, lat: str) -> str:
    """EPSG:4326 degrees to EPSG:2263 feet, ``struct<x, y>``."""
    return _from_cone(_cone_radius(lat), _cone_angle(lon))


def vertices_to_state_plane(vertices: str) -> str:
    """The same for an array of ``struct<x, y>``.

    Lambda bodies are interpreted without common-subexpression elimination, so the cone
    coordinates of a vertex are taken in a step of their own instead of twice.
    """
    cone = f"named_struct('r', {_cone_radius('p_.y')}, 'a', {_cone_angle('p_.x')})"
    return f"transform(transform({vertices}, p_ -> {cone}), k_ -> {_from_cone('k_.r', 'k_.a')})"


def from_state_plane(x: str, y: str) -> str:
    """EPSG:2263 feet to EPSG:4326 degrees, ``struct<lon, lat>``; NULL in, NULL out."""
    east = f"({x} - {FALSE_EASTING_FT!r}D)"
    south = f"({RHO_ORIGIN_FT + FALSE_NORTHING_FT!r}D - {y})"
    t = f"power(sqrt({east} * {east} + {south} * {south}) / {SCALE_FT!r}D, {1 / CONE!r}D)"
    phi = f"(pi() / 2 - 2 * atan({t}))"
    for _ in range(5):
        # the latitude occurs once per step, so the unrolled expression stays linear in size
        phi = f"(pi() / 2 - 2 * atan({t} * exp(-{ECC!r}D * atanh({ECC!r}D * sin({phi})))))"
    lon = f"atan2({east}, {south}) / {CONE!r}D + ({ORIGIN_LON!r}D)"
    return f"named_struct('lon', degrees({lon}), 'lat', degrees({phi}))"


def to_web_mercator(lon: str, lat: str) -> str:
    """EPSG:4326 degrees to EPSG:3857 metres, ``struct<x, y>``."""
    return (
        f"named_struct('x', {SEMI_MAJOR_M!r}D * radians({lon}), "
        f"'y', {SEMI_MAJOR_M!r}D * ln(tan(pi() / 4 + radians({lat}) / 2)))"
    )


def from_web_mercator(x: str, y: str) -> str:
    """EPSG:3857 metres to EPSG:4326 degrees, ``struct<lon, lat>``."""
    return (
        f"named_struct('lon', degrees({x} / {SEMI_MAJOR_M!r}D), "
        f"'lat', degrees(2 * atan(exp({y} / {SEMI_MAJOR_M!r}D)) - pi() / 2))"
    )


_TO_DEGREES = {2263: from_state_plane, 3857: from_web_mercator}
_FROM_DEGREES = {2263: to_state_plane, 3857: to_web_mercator}


def transform_xy(x: str, y: str, source: int, target: int) -> str:
    """``struct<x, y>`` in the target system, going through degrees where needed."""
    for srid in (source, target):
        if srid != 4326 and srid not in _TO_DEGREES:
            raise ValueError(f"unsupported reference system EPSG:{srid}")
    if source == target:
        return f"named_struct('x', {x}, 'y', {y})"
    if source != 4326:
        degrees = _TO_DEGREES[source](x, y)
        x, y = f"{degrees}.lon", f"{degrees}.lat"
    if target == 4326:
        return f"named_struct('x', {x}, 'y', {y})"
    return _FROM_DEGREES[target](x, y)
