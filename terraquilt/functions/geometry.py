"""Planar geometry over the normal form ``struct<type, parts array<array<array<struct<x,y>>>>>``.

Polygon: each part is a closed shell followed by its closed holes. LineString: each part is
one open run of vertices. Point: one part of one run of one vertex. Multi-part shapes stay one
row, so a feature counts once in every cell however many parts it has there.

Like the transforms in :mod:`terraquilt.functions.crs`, functions take and return Spark SQL
expression text; wrap the outermost one in ``F.expr``. Lambda variables end in an underscore.
"""

from __future__ import annotations

GEOMETRY_DDL = "struct<type:string,parts:array<array<array<struct<x:double,y:double>>>>>"


def number(value: float) -> str:
    """DOUBLE literal that is safe inside arithmetic."""
    return f"({float(value)!r}D)"


# ---------------------------------------------------------------- construction

def point(x: str, y: str) -> str:
    return f"named_struct('x', CAST({x} AS DOUBLE), 'y', CAST({y} AS DOUBLE))"


def geometry(kind: str, parts: str) -> str:
    """``kind`` is a plain name such as Polygon."""
    return f"named_struct('type', '{kind}', 'parts', {parts})"


def polygon(*rings: list[tuple[str, str]]) -> str:
    """One part; rings given as lists of (x, y) texts, each already closed."""
    arrays = ", ".join("array(" + ", ".join(point(x, y) for x, y in ring) + ")" for ring in rings)
    return geometry("Polygon", f"array(array({arrays}))")


def line(*vertices: tuple[str, str]) -> str:
    return geometry("LineString", "array(array(array(" + ", ".join(point(x, y) for x, y in vertices) + ")))")


def point_geometry(x: str, y: str) -> str:
    return geometry("Point", f"array(array(array({point(x, y)})))")


def box_ring(xmin: str, ymin: str, xmax: str, ymax: str) -> list[tuple[str, str]]:
    """Counter-clockwise closed rectangle."""
    return [(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin)]


def box_polygon(xmin: str, ymin: str, xmax: str, ymax: str) -> str:
    return polygon(box_ring(xmin, ymin, xmax, ymax))


def bbox_polygon(bbox) -> str:
    return box_polygon(*[number(v) for v in bbox])


# ---------------------------------------------------------------- GeoJSON

def _vertex(pair: str) -> str:
    return f"named_struct('x', {pair}[0], 'y', {pair}[1])"


def _run(pairs: str) -> str:
    return f"transform({pairs}, v_ -> {_vertex('v_')})"


def geometry_from_geojson(geojson: str) -> str:
    """GeoJSON struct with its coordinates as text to the normal form; NULL for other types."""
    def parsed(depth: int) -> str:
        return f"from_json({geojson}.coordinates, '{'array<' * depth}double{'>' * depth}')"

    def rings(value: str) -> str:
        return f"transform({value}, r_ -> {_run('r_')})"

    return f"""CASE {geojson}.type
        WHEN 'Polygon' THEN {geometry("Polygon", f"array({rings(parsed(3))})")}
        WHEN 'MultiPolygon' THEN {geometry("Polygon", f"transform({parsed(4)}, g_ -> {rings('g_')})")}
        WHEN 'LineString' THEN {geometry("LineString", f"array(array({_run(parsed(2))}))")}
        WHEN 'MultiLineString' THEN {geometry("LineString", f"transform({parsed(3)}, g_ -> array({_run('g_')}))")}
        WHEN 'Point' THEN {geometry("Point", f"array(array(array({_vertex(parsed(1))})))")}
        END"""


def geometry_to_geojson(geom: str) -> str:
    """Normal form back to GeoJSON text."""
    pairs = f"transform({geom}.parts, g_ -> transform(g_, r_ -> transform(r_, p_ -> array(p_.x, p_.y))))"
    several = f"size({geom}.parts) > 1"
    body = f"""CASE WHEN {geom}.type = 'Polygon' AND {several} THEN to_json({pairs})
        WHEN {geom}.type = 'Polygon' THEN to_json(get({pairs}, 0))
        WHEN {geom}.type = 'LineString' AND {several} THEN to_json(flatten({pairs}))
        WHEN {geom}.type = 'LineString' THEN to_json(get(flatten({pairs}), 0))
        ELSE to_json(get(flatten(flatten({pairs})), 0)) END"""
    return (
        f"""concat('{{"type":"', IF({several}, 'Multi', ''), {geom}.type, '","coordinates":', {body}, '}}')"""
    )


# ---------------------------------------------------------------- measures

def ring_edges(ring: str) -> str:
    """Consecutive vertex pairs as ``struct<x1, y1, x2, y2>``."""
    steps = f"greatest(size({ring}) - 1, 0)"
    return (
        f"zip_with(slice({ring}, 1, {steps}), slice({ring}, 2, {steps}), "
        f"(a_, b_) -> named_struct('x1', a_.x, 'y1', a_.y, 'x2', b_.x, 'y2', b_.y))"
    )


def edges_of_parts(parts: str) -> str:
    return f"flatten(transform(flatten({parts}), r_ -> {ring_edges('r_')}))"


def geometry_edges(geom: str) -> str:
    return edges_of_parts(f"{geom}.parts")


def vertices(parts: str) -> str:
    return f"flatten(flatten({parts}))"


def envelope(geom: str) -> str:
    """Bounding box ``struct<xmin, ymin, xmax, ymax>``."""
    xs, ys = (f"{vertices(f'{geom}.parts')}.{axis}" for axis in "xy")
    return (
        f"named_struct('xmin', array_min({xs}), 'ymin', array_min({ys}), "
        f"'xmax', array_max({xs}), 'ymax', array_max({ys}))"
    )


def signed_ring_area(ring: str) -> str:
    """Shoelace sum, taken relative to the first vertex to keep digits; > 0 is counter-clockwise."""
    x, y = f"{ring}[0].x", f"{ring}[0].y"
    term = f"(e_.x1 - {x}) * (e_.y2 - {y}) - (e_.x2 - {x}) * (e_.y1 - {y})"
    return f"(aggregate({ring_edges(ring)}, 0D, (acc_, e_) -> acc_ + ({term})) / 2)"


def parts_area(parts: str) -> str:
    """Shell areas minus the holes; 0 without parts."""
    areas = f"transform({parts}, g_ -> transform(g_, (r_, i_) -> abs({signed_ring_area('r_')}) * IF(i_ = 0, 1, -1)))"
    return f"aggregate(flatten({areas}), 0D, (sum_, a_) -> sum_ + a_)"


def transform_parts(parts: str, project) -> str:
    """Apply ``project(array of struct<x, y>) -> the same`` to every ring or run."""
    return f"transform({parts}, g_ -> transform(g_, r_ -> {project('r_')}))"


def parts_length(parts: str) -> str:
    length = "sqrt(power(e_.x2 - e_.x1, 2) + power(e_.y2 - e_.y1, 2))"
    return f"aggregate({edges_of_parts(parts)}, 0D, (acc_, e_) -> acc_ + {length})"


def orient_parts(parts: str) -> str:
    """Shells counter-clockwise, holes clockwise."""
    area = signed_ring_area("r_")
    turned = f"transform(g_, (r_, i_) -> IF(({area} > 0) = (i_ = 0), r_, reverse(r_)))"
    return f"transform({parts}, g_ -> {turned})"


# ---------------------------------------------------------------- predicates

def point_in_edges(x: str, y: str, edges: str) -> str:
    """Even-odd rule over all edges, so holes count as outside."""
    crosses = (
        f"(e_.y1 > {y}) != (e_.y2 > {y}) "
        f"AND {x} < e_.x1 + ({y} - e_.y1) * (e_.x2 - e_.x1) / (e_.y2 - e_.y1)"
    )
    return f"(aggregate({edges}, 0, (acc_, e_) -> acc_ + IF({crosses}, 1, 0)) % 2 = 1)"


def edge_meets_box(xmin: str, ymin: str, xmax: str, ymax: str) -> str:
    """Closed edge ``e_`` against closed box, by separating axes: x, y and the edge's normal."""
    dx, dy = "(e_.x2 - e_.x1)", "(e_.y2 - e_.y1)"

    def side(x: str, y: str) -> str:
        return f"({dx} * ({y} - e_.y1) - {dy} * ({x} - e_.x1))"

    # the two corners farthest apart across the edge lie on a diagonal that depends on its slope
    across = (
        f"IF({dx} * {dy} >= 0, {side(xmin, ymax)} * {side(xmax, ymin)}, {side(xmin, ymin)} * {side(xmax, ymax)})"
    )
    return (
        f"least(e_.x1, e_.x2) <= {xmax} AND greatest(e_.x1, e_.x2) >= {xmin} "
        f"AND least(e_.y1, e_.y2) <= {ymax} AND greatest(e_.y1, e_.y2) >= {ymin} AND {across} <= 0"
    )


def any_edge_meets_box(edges: str, box: tuple[str, str, str, str]) -> str:
    return f"exists({edges}, e_ -> {edge_meets_box(*box)})"


def box_in_area(kind: str, edges: str, box: tuple[str, str, str, str]) -> str:
    """A box no edge meets lies wholly inside an area or wholly outside; one corner tells."""
    return f"({kind} = 'Polygon' AND {point_in_edges(box[0], box[1], edges)})"


def box_intersects(kind: str, edges: str, box: tuple[str, str, str, str]) -> str:
    """Shape meets the closed box ``(xmin, ymin, xmax, ymax)``; touching counts."""
    return f"({any_edge_meets_box(edges, box)} OR {box_in_area(kind, edges, box)})"


# ---------------------------------------------------------------- clipping

def box_sides(xmin: str, ymin: str, xmax: str, ymax: str) -> str:
    """The four half-planes of a rectangle, as an array; see :func:`half_planes`."""
    def side(nx: int, ny: int, x: str, y: str) -> str:
        return f"named_struct('nx', {nx}D, 'ny', {ny}D, 'x', CAST({x} AS DOUBLE), 'y', CAST({y} AS DOUBLE))"

    return "array(" + ", ".join([
        side(1, 0, xmin, ymin), side(-1, 0, xmax, ymin), side(0, 1, xmin, ymin), side(0, -1, xmin, ymax),
    ]) + ")"


def half_planes(ring: str) -> str:
    """The half-planes whose intersection is a convex closed ring, whichever way it turns.

    Each is ``nx (px - x) + ny (py - y) >= 0``: differences of coordinates from a vertex of the ring keep the digits that a
    constant term would lose.
    """
    turn = f"IF({signed_ring_area(ring)} >= 0, 1D, -1D)"
    nx, ny = f"(h_.y1 - h_.y2) * {turn}", f"(h_.x2 - h_.x1) * {turn}"
    plane = f"named_struct('nx', {nx}, 'ny', {ny}, 'x', h_.x1, 'y', h_.y1)"
    return f"transform(filter({ring_edges(ring)}, f_ -> f_.x1 <> f_.x2 OR f_.y1 <> f_.y2), h_ -> {plane})"


def _least_and_most(box: tuple[str, str, str, str]) -> tuple[str, str]:
    """How far the corners of an envelope lie within half-plane ``s_``, at least and at most."""
    def reach(low: str, high: str, n: str, at: str) -> tuple[str, str]:
        return f"{n} * (IF({n} >= 0, {low}, {high}) - {at})", f"{n} * (IF({n} >= 0, {high}, {low}) - {at})"

    (x_least, x_most), (y_least, y_most) = reach(box[0], box[2], "s_.nx", "s_.x"), reach(box[1], box[3], "s_.ny", "s_.y")
    return f"({x_least} + {y_least})", f"({x_most} + {y_most})"


def cutting_sides(sides: str, box: tuple[str, str, str, str]) -> str:
    """The half-planes that don't hold the whole envelope: a shape within the others isn't cut by them."""
    return f"filter({sides}, s_ -> {_least_and_most(box)[0]} < 0)"


def beyond_sides(sides: str, box: tuple[str, str, str, str]) -> str:
    """Whether the envelope lies beyond a half-plane, or touches it from there: nothing with an area is within."""
    return _any_side(sides, f"{_least_and_most(box)[1]} <= 0")


def any_side_cuts(sides: str, box: tuple[str, str, str, str]) -> str:
    """Whether a half-plane doesn't hold the whole envelope; see :func:`cutting_sides`."""
    return _any_side(sides, f"{_least_and_most(box)[0]} < 0")


def _any_side(sides: str, test: str, written: int = 4) -> str:
    """Whether a half-plane ``s_`` passes a test; the first ones are written out, as lambdas are interpreted."""
    tests = [f"coalesce({test.replace('s_.', f'get({sides}, {i}).')}, false)" for i in range(written)]
    rest = f"slice({sides}, {written + 1}, greatest(size({sides}) - {written}, 0))"
    return f"({' OR '.join(tests)} OR (size({sides}) > {written} AND exists({rest}, s_ -> {test})))"


def clip_ring_to_sides(ring: str, sides: str) -> str:
    """Closed ring cut to the intersection of half-planes: one cut per side (Sutherland-Hodgman)."""
    def within(x: str, y: str) -> str:
        return f"(s_.nx * ({x} - s_.x) + s_.ny * ({y} - s_.y))"

    placed = f"transform(acc_, v_ -> named_struct('x', v_.x, 'y', v_.y, 'd', {within('v_.x', 'v_.y')}))"
    steps = "greatest(size(w_) - 1, 0)"
    edges = f"transform(array({placed}), w_ -> zip_with(slice(w_, 1, {steps}), slice(w_, 2, {steps}), (a_, b_) -> named_struct('a', a_, 'b', b_)))[0]"
    t = "(e_.a.d / (e_.a.d - e_.b.d))"
    crossing = point(f"e_.a.x + {t} * (e_.b.x - e_.a.x)", f"e_.a.y + {t} * (e_.b.y - e_.a.y)")
    end = point("e_.b.x", "e_.b.y")
    pieces = f"""CASE WHEN e_.a.d >= 0 AND e_.b.d >= 0 THEN array({end})
        WHEN e_.a.d >= 0 THEN array({crossing})
        WHEN e_.b.d >= 0 THEN array({crossing}, {end})
        ELSE slice(array({end}), 1, 0) END"""
    cut = f"flatten(transform({edges}, e_ -> {pieces}))"
    closed = f"transform(array({cut}), q_ -> concat(q_, slice(q_, 1, 1)))[0]"
    return f"aggregate({sides}, {ring}, (acc_, s_) -> {closed})"


def clip_ring_to_box(ring: str, xmin: str, ymin: str, xmax: str, ymax: str) -> str:
    return clip_ring_to_sides(ring, box_sides(xmin, ymin, xmax, ymax))


def clip_parts_to_sides(parts: str, sides: str) -> str:
    """Every ring cut to the half-planes; a shell with nothing left takes its holes with it."""
    rings = f"filter(transform(g_, r_ -> {clip_ring_to_sides('r_', sides)}), k_ -> size(k_) >= 4)"
    return f"filter(transform({parts}, g_ -> {rings}), k_ -> size(k_) > 0)"


def clip_parts_to_box(parts: str, box: tuple[str, str, str, str]) -> str:
    """Every ring cut to the rectangle; a shape already inside it is passed on as it is.

    A shell with nothing left takes its holes with it, so the remaining order still holds.
    """
    xmin, ymin, xmax, ymax = box
    inside = f"p_.x >= {xmin} AND p_.x <= {xmax} AND p_.y >= {ymin} AND p_.y <= {ymax}"
    rings = f"filter(transform(g_, r_ -> {clip_ring_to_box('r_', *box)}), k_ -> size(k_) >= 4)"
    clipped = f"filter(transform({parts}, g_ -> {rings}), k_ -> size(k_) > 0)"
    return f"IF(forall({vertices(parts)}, p_ -> {inside}), {parts}, {clipped})"
