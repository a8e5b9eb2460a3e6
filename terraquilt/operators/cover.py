"""Features to grid cells, statistics per cell, and joins between shapes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from terraquilt.functions import crs, geometry as geo, planar
from terraquilt.grid import GridSpec
from terraquilt.operators import meeting
from terraquilt.operators.skew import crossed_join, dealt_sides
from terraquilt.session import cut_lineage, settled

BLOCK = 64


def once(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add columns that are computed once per row and not again at each place they are used.

    A projected expression may be copied into filters below it; the output of a generator
    is not.
    """
    fields = ", ".join(f"'{name}', {text}" for name, text in columns.items())
    return df.select("*", F.expr(f"inline(array(named_struct({fields})))"))


def _narrowed(where: str) -> Column:
    """The edges left to look at, fewer at each step down."""
    return F.expr(f"filter(_edges, e_ -> {where})")


def cover_cells(
    features: DataFrame, grid: GridSpec, geometry: str = "geometry", block: int = BLOCK, spread: bool = True
) -> DataFrame:
    """One row per feature and grid cell that share at least a point; adds ``row``, ``col``.

    Candidates come from the envelope: rows of blocks, blocks, rows of cells, cells. Each step
    keeps only the edges that can still matter: those that reach its rows and don't lie wholly
    west of it (edges to the east count for the inside test). Blocks that miss the shape are
    dropped whole and cells of blocks inside it need no test, so a large shape pays for its
    border only, and a cell looks at the few edges of its row. Touching counts. Rows without
    geometry, or with an empty one, cover nothing.

    The geometry of an area in the result is its part within the cell's block, which is all that a clip to the
    cell needs; lines stay whole. Where nobody reads it, it isn't computed.

    With ``spread`` the blocks are dealt out evenly before the exact tests. Moving a row costs
    far less than testing it, and no task is left with one huge shape or a file full of them.
    """
    # one cell of margin on either side covers shapes that end on a cell border
    shaped = features.where(f"{geometry} IS NOT NULL AND size({geo.vertices(f'{geometry}.parts')}) > 0")
    span = {
        "_c0": F.expr(f"greatest({grid.col_of('_env.xmin')} - 1, 0)"),
        "_c1": F.expr(f"least({grid.col_of('_env.xmax')} + 1, {grid.width - 1})"),
        "_r0": F.expr(f"greatest({grid.row_of('_env.ymax')} - 1, 0)"),
        "_r1": F.expr(f"least({grid.row_of('_env.ymin')} + 1, {grid.height - 1})"),
    }
    # the kind is a column of its own, as the type of a clipped shape would hold on to the shape where nobody reads it
    local = once(shaped, {
        "_kind": f"{geometry}.type", "_env": geo.envelope(geometry), "_edges": geo.geometry_edges(geometry),
    }).withColumns(span)

    def blocks(axis: str) -> Column:
        """Blocks the envelope reaches; none if it misses the grid."""
        low, high = f"_{axis}0", f"_{axis}1"
        span = f"sequence({low} div {block}, {high} div {block})"
        return F.expr(f"explode(IF({low} <= {high}, {span}, slice(sequence(0L, 0L), 1, 0)))")

    def cells(axis: str, low: str, high: str, overlap: str, more: str = "") -> Column:
        """Indices of a block's lines that the envelope reaches, with their edges."""
        span = (
            f"sequence(greatest(_{axis}0, CAST(_b{axis} * {block} AS INT)), "
            f"least(_{axis}1, CAST(_b{axis} * {block} + {block - 1} AS INT)))"
        )
        lines = f"transform({span}, i_ -> named_struct('i', i_, 'low', {low}, 'high', {high}{more}))"
        return F.expr(f"explode(filter({lines}, k_ -> {overlap}))")

    def reaches(low: str, high: str) -> str:
        return f"least(e_.y1, e_.y2) <= {high} AND greatest(e_.y1, e_.y2) >= {low}"

    def part(box: tuple[str, str, str, str]) -> Column:
        clipped = geo.geometry("Polygon", geo.clip_parts_to_box(f"{geometry}.parts", box))
        return F.expr(f"IF(_kind = 'Polygon', {clipped}, {geometry})")

    _, south, _, north = grid.box(f"(_br * {block})", "0", block)
    west, _, east, _ = grid.box("0", f"(_bc * {block})", 1, block)
    box = (west, south, east, north)
    strips = local.withColumn("_br", blocks("r"))
    strips = strips.withColumns({
        "_edges": _narrowed(reaches(south, north)), geometry: part(("_env.xmin", south, "_env.xmax", north)),
    })
    split = strips.withColumn("_bc", blocks("c")).withColumn("_edges", _narrowed(f"greatest(e_.x1, e_.x2) >= {west}"))
    if spread:
        # what the envelope tells isn't moved with it
        tasks = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        split = split.drop(*span).repartition(tasks).withColumns(span)
    near = split.withColumn("_border", F.expr(geo.any_edge_meets_box("_edges", box))).where(
        f"_border OR {geo.box_in_area('_kind', '_edges', box)}"
    ).withColumn(geometry, part(box))
    x_low, y_low, x_high, y_high = grid.box("i_", "i_")
    own = f"IF(_border, filter(_edges, e_ -> {reaches(y_low, y_high)}), slice(_edges, 1, 0))"
    lines = near.withColumn("_r", cells(
        "r", y_low, y_high, "k_.low <= _env.ymax AND k_.high >= _env.ymin", f", 'edges', {own}"
    ))
    candidates = lines.withColumn("_c", cells("c", x_low, x_high, "k_.low <= _env.xmax AND k_.high >= _env.xmin"))
    exact = geo.box_intersects("_kind", "_r.edges", ("_c.low", "_r.low", "_c.high", "_r.high"))
    return candidates.where(f"NOT _border OR {exact}").select(
        *features.columns, F.col("_r.i").alias("row"), F.col("_c.i").alias("col")
    )


def clip_area_sqft(grid: GridSpec, geometry: str = "geometry") -> Column:
    """Area of a shape within its cell, in square feet of EPSG:2263; cut in degrees, then projected."""
    pieces = geo.clip_parts_to_box(f"{geometry}.parts", grid.box("row", "col"))
    return F.expr(geo.parts_area(geo.transform_parts(pieces, crs.vertices_to_state_plane)))


ENTROPY_BIN = 3
ENTROPY_LIMIT = 180


def statistic(name: str, value: Column) -> Column:
    """Aggregate of one cell by name; empty cells get theirs from :data:`EMPTY`."""
    if name == "mean":
        return F.avg(value)
    if name == "std_dev":
        return F.stddev_pop(value)
    if name == "mode":
        return F.mode(value, True)
    if name == "count":
        return F.count(value)
    if name == "presence":
        return F.least(F.count(value), F.lit(1))
    if name == "sum_area":
        return F.sum(value)
    if name == "entropy":
        return _entropy_of_bins(value)
    raise ValueError(f"unknown statistic {name!r}; known: {sorted(EMPTY)}")


def _entropy_of_bins(value: Column) -> Column:
    """Shannon entropy (nats) of the bins ``[0,3) .. [177,180)`` from one counter per bin; NULL without any."""
    counts = F.array(*[
        F.count_if((value >= low) & (value < low + ENTROPY_BIN)) for low in range(0, ENTROPY_LIMIT, ENTROPY_BIN)
    ])
    terms = F.transform(F.filter(counts, lambda n: n > 0), lambda n: F.struct(
        n.cast("double").alias("n"), (n * F.ln(n)).alias("nlogn")
    ))
    total = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t["n"])
    weighted = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t["nlogn"])
    return F.when(total > 0, F.greatest(F.ln(total) - weighted / total, F.lit(0.0)))


# What a cell without members holds.
EMPTY = {"mean": 0.0, "std_dev": -1.0, "mode": -1, "count": 0, "presence": 0, "sum_area": 0.0, "entropy": None}


def on_grid(stats: DataFrame, grid: GridSpec, defaults: dict) -> DataFrame:
    """Every cell of the grid, with defaults where a cell has no row."""
    cells = grid.cells(stats.sparkSession)
    joined = cells.join(stats, ["row", "col"], "left")
    return joined.select("row", "col", *[
        F.coalesce(F.col(c), F.lit(d)).alias(c) if d is not None else F.col(c) for c, d in defaults.items()
    ])


def cell_statistics(cover: DataFrame, requests: dict[str, tuple[str, Column]], grid: GridSpec) -> DataFrame:
    """Several statistics of a cover in one aggregation, on the full grid.

    ``requests`` maps the output name to (statistic name, value). ``mode`` keeps one counter
    per distinct value of a cell, so its value should be a category code.
    """
    aggregates = [statistic(name, value).alias(out) for out, (name, value) in requests.items()]
    stats = cover.groupBy("row", "col").agg(*aggregates)
    return on_grid(stats, grid, {out: EMPTY[name] for out, (name, _) in requests.items()})


def cell_mode(cover: DataFrame, value: Column, grid: GridSpec, name: str = "mode") -> DataFrame:
    """Most frequent value per cell, smallest on ties; any number of distinct values per cell."""
    counts = cover.where(value.isNotNull()).groupBy("row", "col", value.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy("row", "col").agg(
        F.min_by("_v", F.struct((-F.col("_n")).alias("n"), F.col("_v").alias("v"))).alias(name)
    )
    return on_grid(best, grid, {name: EMPTY["mode"]})


def cell_entropy(cover: DataFrame, value: Column, grid: GridSpec, name: str = "entropy") -> DataFrame:
    """Shannon entropy (nats) of values in bins ``[0,3) .. [177,180)``; NULL for cells without any."""
    binned = cover.where((value >= 0) & (value < ENTROPY_LIMIT))
    counts = binned.groupBy("row", "col", F.floor(value / ENTROPY_BIN).alias("_bin")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    n = F.col("_n")
    # -sum(p ln p) = ln N - sum(n ln n) / N: one aggregation, no second look at the cell
    entropy = counts.groupBy("row", "col").agg(
        F.greatest(F.ln(F.sum(n)) - F.sum(n * F.ln(n)) / F.sum(n), F.lit(0.0)).alias(name)
    )
    return on_grid(entropy, grid, {name: None})


def cell_category_counts(cover: DataFrame, code: Column, names: dict[str, int | str], grid: GridSpec) -> DataFrame:
    """Members per category and cell; all categories in one pass, not clipped to 0/1."""
    counts = [F.count_if(code == value).alias(name) for name, value in names.items()]
    return on_grid(cover.groupBy("row", "col").agg(*counts), grid, {name: 0 for name in names})


# ---------------------------------------------------------------- shape joins

#: A shape's bins are the first of which so many side by side are as wide as it is.
BINS_ACROSS = 4


ENDS = ("xmin", "ymin", "xmax", "ymax")


def _leveled(df: DataFrame, geometry: str, side: str, cell: float, by: str | None = None) -> DataFrame:
    """Envelope as ``_lxmin`` (``_rxmin``) and so on, and its level: ``BINS_ACROSS`` bins of side ``cell * 2 ** level`` are the first as wide as it is.

    With ``by`` these are of all rows that share a value of that column, and a row's own envelope is ``_lown_xmin`` and so on.
    """
    placed = once(df, {"_env": geo.envelope(geometry)}).withColumns({f"_{side}{end}": F.col(f"_env.{end}") for end in ENDS}).drop("_env")
    span = f"greatest(_{side}xmax - _{side}xmin, _{side}ymax - _{side}ymin)"
    placed = placed.where(f"{span} < double('infinity')")
    if by:
        shared = Window.partitionBy(by)
        placed = placed.withColumnsRenamed({f"_{side}{end}": f"_{side}own_{end}" for end in ENDS})
        placed = placed.withColumns({
            f"_{side}{end}": (F.min if end in ENDS[:2] else F.max)(f"_{side}own_{end}").over(shared) for end in ENDS
        }).where(f"{span} < double('infinity')")
    level = f"CAST(IF({span} <= {cell * BINS_ACROSS}D, 0, ceil(log2({span} / {cell * BINS_ACROSS}D))) AS INT)"
    return placed.withColumn(f"_{side}l", F.expr(level))


def _binned(placed: DataFrame, side: str, cell: float, levels: list[int]) -> DataFrame:
    """A row for each bin a shape reaches at the levels where it meets any of ``levels``, those of the other side.

    These are the coarser ones of them, and its own level if any of them is as fine or finer. At its own a shape reaches up to 25
    bins, at coarser ones four or so. ``_lx``, ``_ly`` (``_rx``, ``_ry``) is the bin of its lower-left corner.
    """
    others = "array(" + ", ".join(map(str, levels)) + ")" if levels else "CAST(array() AS array<int>)"
    meeting = f"array_distinct(transform({others}, l_ -> greatest(l_, _{side}l)))"
    own = placed.withColumn("_level", F.expr(f"explode({meeting})"))
    for axis in "xy":
        size = f"({cell}D * power(2D, _level))"
        first = f"floor(_{side}{axis}min / {size})"
        own = own.withColumn(f"_{side}{axis}", F.expr(first))
        own = own.withColumn(f"_b{axis}", F.expr(f"explode(sequence(_{side}{axis}, floor(_{side}{axis}max / {size})))"))
    return own


def _spread(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly: the shapes of a small file are work for many tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def envelope_join(
    left: DataFrame, right: DataFrame, cell: float, left_geometry: str = "geometry", right_geometry: str = "aoi",
    left_values: dict[str, str] | None = None, right_values: dict[str, str] | None = None,
) -> DataFrame:
    """Pairs whose envelopes share a point, by equi-join on bins of several levels; ``_lxmin`` to ``_rymax`` are the envelopes.

    A shape lies in bins of a fourth of its size or more, and stands in coarser ones for the larger shapes of the
    other side, so its rows don't grow with its extent: at most 25 at its own level and about four for each other there is. Pairs
    that share a bin are about twice those whose envelopes meet, as bins are small beside the larger shape. ``cell`` is the
    side of the finest bins, those of shapes up to four times that size. Either side may be of any size. A pair meets at the
    level of its larger shape, in the one bin holding the larger of the two lower-left corners, so nothing has to
    be made distinct. Shapes without envelope meet nothing. A bin with a large share of all pairs, as one that shapes as
    wide as the data make, is dealt over many tasks.

    ``left_values`` and ``right_values`` are expressions that are computed once a shape, before it meets any other.
    """
    a, b = (
        cut_lineage(_leveled(once(spread, values) if values else spread, geometry, side, cell))
        for spread, values, geometry, side in (
            (_spread(left), left_values, left_geometry, "l"), (_spread(right), right_values, right_geometry, "r"),
        )
    )
    # a few dozen numbers
    levels = {side: sorted(r[0] for r in df.select(f"_{side}l").distinct().collect()) for side, df in (("l", a), ("r", b))}
    pairs = crossed_join(_binned(a, "l", cell, levels["r"]), _binned(b, "r", cell, levels["l"]), ["_level", "_bx", "_by"])
    return pairs.where(
        "_lxmin <= _rxmax AND _lxmax >= _rxmin AND _lymin <= _rymax AND _lymax >= _rymin "
        "AND greatest(_ll, _rl) = _level AND greatest(_lx, _rx) = _bx AND greatest(_ly, _ry) = _by"
    ).drop("_level", "_bx", "_by", "_ll", "_rl", "_lx", "_ly", "_rx", "_ry")


#: Rows of either side that meet in one slot of a block, at most, and so what a worker holds of them.
BLOCK_ROWS = 100_000
#: Placed shapes of a file, at most: those of one input task are read again by many.
FILE_ROWS = 50_000


def _meet(
    sides: tuple[DataFrame, DataFrame], geometries: tuple[str, str], values: tuple[dict[str, str] | None, dict[str, str] | None], cell: float,
    kept: tuple[list[str], list[str]], kernel: meeting.Meeting | meeting.Overlay, schema: StructType, by: tuple[str, str] | None = None,
) -> DataFrame:
    """What ``kernel`` makes of the pairs whose envelopes share a point, of which each comes up once.

    Shapes are dealt to square blocks: those of a shape are as wide as it is or up to four times as wide, and it stands in coarser ones for the larger
    shapes of the other side. So it has four rows at its own level at most and about one for each other level, whatever there
    is inside a block; pairs within one are found by a worker, batch by batch. A pair meets at the level of its larger shape, in
    the block holding the larger of the two lower-left corners. Blocks with a large share of the pairs, or many rows, are dealt over
    a grid of slots, so neither one place with most shapes nor shapes as wide as the data make one task.

    ``values`` are computed once a shape. With ``by``, a column of each side, all rows of a pair of their values meet in one slot.
    """
    tasks = int(sides[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own_ends = [f"own_{end}" for end in ENDS] if by else []

    def placed(k: int, side: str) -> DataFrame:
        if by:
            shapes = sides[k].repartition(tasks, by[k])
        else:  # an envelope costs less than the move of a shape, values may not
            shapes = _spread(sides[k]) if values[k] else sides[k]
        found = _leveled(once(shapes, values[k]) if values[k] else shapes, geometries[k], side, cell, by and by[k])
        narrow = found.select(
            F.struct(*kept[k]).alias(f"_{side}"), *[f"_{side}{end}" for end in (*ENDS, *own_ends)], F.expr(f"(_{side}l + 1) div 2 * 2").cast("int").alias(f"_{side}l")
        )
        return settled(narrow, "shapes", FILE_ROWS)

    a, b = placed(0, "l"), placed(1, "r")
    # a dozen numbers
    levels = {side: sorted(r[0] for r in df.select(f"_{side}l").distinct().collect()) for side, df in (("l", a), ("r", b))}
    left, right = _binned(a, "l", cell * BINS_ACROSS, levels["r"]), _binned(b, "r", cell * BINS_ACROSS, levels["l"])
    size = f"({cell * BINS_ACROSS}D * power(2D, _level))"
    stats = {
        side: {f"_{side}{name}": f"avg(least(_{side}{axis}max - _{side}{axis}min, {size}))" for axis, name in (("x", "wide"), ("y", "high"))}
        for side in "lr"
    }
    left, right, keys = dealt_sides(
        left, right, ["_level", "_bx", "_by"], work=f"_n * _m * least(1D, (_lwide + _rwide) * (_lhigh + _rhigh) / ({size} * {size}))",
        left_stats=stats["l"], right_stats=stats["r"], most_rows=BLOCK_ROWS, by=by and (f"_l.`{by[0]}`", f"_r.`{by[1]}`"),
    )

    def rows(df: DataFrame, side: str, other: DataFrame, number: int) -> DataFrame:
        none = {name: F.lit(None).cast(other.schema[name].dataType) for name in ("_l", "_r") if name != f"_{side}"}
        return df.select(
            *keys, F.lit(number).alias("_side"), F.col(f"_{side}l").alias("_own"), F.col(f"_{side}x").alias("_cx"), F.col(f"_{side}y").alias("_cy"),
            *[F.col(f"_{side}{end}").alias(f"_{end}") for end in (*ENDS, *own_ends)], *[none.get(name, F.col(name)).alias(name) for name in ("_l", "_r")],
        )

    both = rows(left, "l", right, 0).unionByName(rows(right, "r", left, 1))
    ordered = both.repartition(tasks, *keys).sortWithinPartitions(*keys, "_side")
    return ordered.mapInArrow(meeting.worker(kernel, keys, by), schema)


def _wanted(columns: list[str], chosen: list[str] | None, *without: str) -> list[str]:
    return [c for c in columns if c not in without and (chosen is None or c in chosen)]


def _fields(df: DataFrame, columns: list[str]) -> list[StructField]:
    return [StructField(c, df.schema[c].dataType) for c in columns]


def aoi_join(
    shapes: DataFrame, boxes: DataFrame, cell: float = 0.0001, geometry: str = "geometry", box: str = "aoi", columns: list[str] | None = None,
) -> DataFrame:
    """Shapes with every rectangle they meet (inner join on intersects); of all columns or those in ``columns``, which are cheaper to move.

    Of pairs whose envelopes meet, a shape inside the rectangle needs no test, nor does one run or ring of vertices that
    lies between two opposite sides: it is connected, so it meets whatever its envelope meets there.
    """
    kept = _wanted(shapes.columns, columns), _wanted(boxes.columns, columns)
    schema = StructType(_fields(shapes, kept[0]) + _fields(boxes, kept[1]))
    kernel = meeting.Meeting(*kept, geometry)
    return _meet((shapes, boxes), (geometry, box), (None, None), cell, ([*dict.fromkeys([*kept[0], geometry])], kept[1]), kernel, schema)


@dataclass(frozen=True)
class Measure:
    """A number of a piece: from the text of its parts, and the same from arrays, for many pieces at once."""

    text: Callable[[str], str]
    arrays: planar.Measure

    def __call__(self, parts: str) -> str:
        return self.text(parts)


Measures = dict[str, Callable[[str], str]]
#: What can be measured without an array form of its own.
ARRAYS: dict[Callable[[str], str], planar.Measure] = {geo.parts_area: planar.areas}


def _overlay(
    shapes: DataFrame, tiles: DataFrame, cell: float, geometry: str, tile: str, measures: Measures | None, columns: list[str] | None,
    by: tuple[str, str] | None, scaled: tuple[float, int] | None, sides: dict[str, str] | None,
) -> DataFrame:
    """Shapes cut to convex tiles, without pieces of no area; see :func:`overlay_convex`. ``sides`` are a tile's half-planes, those of its envelope if not given.

    Measures with an array form are taken where the piece is cut. For others the piece is handed back, and a whole shape brings its own along.
    """
    measures = measures or {}
    arrays = {name: measure.arrays if isinstance(measure, Measure) else ARRAYS.get(measure) for name, measure in measures.items()}
    handed = not all(arrays.values())
    own = {f"_own_{name}": measure(f"{geometry}.parts") for name, measure in measures.items()} if handed else {}
    kept = _wanted(shapes.columns, columns), _wanted(tiles.columns, columns, tile)
    if by and not handed:
        out, kernel_by = ([by[0]], [by[1]]), by
    else:
        out, kernel_by = ([*dict.fromkeys([*kept[0], *([geometry] if handed else []), *own, *(by[:1] if by else [])])], [*dict.fromkeys([*kept[1], *(by[1:] if by else [])])]), None
    kernel = meeting.Overlay(*out, geometry, {} if handed else arrays, handed, [*(sides or {})], kernel_by, scaled)
    doubles = [] if handed else [StructField(name, DoubleType()) for name in measures]
    own_fields = [StructField(name, DoubleType()) for name in own]
    schema = StructType(
        _fields(shapes, [c for c in out[0] if c not in own]) + own_fields + _fields(tiles, out[1]) + doubles
        + ([StructField("_whole", BooleanType())] if handed else [])
    )
    found = _meet(
        (shapes, tiles), (geometry, tile), (own or None, sides), cell, ([*dict.fromkeys([*out[0], geometry])], [*out[1], *(sides or {})]), kernel, schema, kernel_by,
    )
    if handed:
        found = found.withColumns({
            name: F.expr(f"IF(_whole, _own_{name}, {measure(f'{geometry}.parts')})") for name, measure in measures.items()
        })
        if by:
            totals = {name: F.sum(name) if scaled is None else F.round(F.sum(name) * scaled[0], scaled[1]) for name in measures}
            found = found.groupBy(*by).agg(*[total.alias(name) for name, total in totals.items()])
    return found.select(*(by or (*kept[0], *kept[1])), *measures)


def overlay_intersection(
    shapes: DataFrame, boxes: DataFrame, cell: float = 0.0001, geometry: str = "geometry", box: str = "aoi",
    measures: Measures | None = None, columns: list[str] | None = None,
) -> DataFrame:
    """Pairwise intersection of polygons and rectangles; pairs without common area are left out.

    ``measures`` adds columns by name, each from a function of the text of a piece's parts or a :class:`Measure`; a shape that is its own
    piece in many rectangles is measured once. ``columns`` names the others that are wanted; without ``geometry`` no piece is handed on.
    """
    return _overlay(shapes, boxes, cell, geometry, box, measures, columns, None, None, None)


def overlay_convex(
    shapes: DataFrame, tiles: DataFrame, cell: float = 0.0001, geometry: str = "geometry", tile: str = "tile_geometry",
    measures: Measures | None = None, columns: list[str] | None = None, by: tuple[str, str] | None = None,
    scaled: tuple[float, int] | None = None,
) -> DataFrame:
    """Pairwise intersection of polygons and convex tiles of any orientation; pairs without common area are left out.

    A tile is a polygon of one ring without holes, in either direction; a rectangle taken to another system is one.
    ``measures`` and ``columns`` as in :func:`overlay_intersection`. With ``by``, a column of the shapes and one of the tiles, the result
    is these and the sums of the measures over all pieces that share their values, NULL being one. The pieces of such a pair are
    cut in one place, so that the sums need no shuffle of pairs. ``scaled``, a factor and a number of digits, is for sums multiplied and rounded as
    Spark's ``round`` does it, many at once.
    """
    return _overlay(shapes, tiles, cell, geometry, tile, measures, columns, by, scaled, {"_sides": geo.half_planes(f"{tile}.parts[0][0]")})
