"""Checked queries: series, text, category and pattern operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraquilt.functions import crs, maths, text
from terraquilt.operators import features as ft, labels, patterns, series
from terraquilt.plans.fixtures import load, num, streets, table, with_inputs
from terraquilt.plans.registry import query, rounded
from terraquilt.session import fresh_path
from terraquilt.sources import readers, writers
from terraquilt.streaming import skip_existing

CLEAN = "average > 0 AND year >= 1958 AND month BETWEEN 1 AND 12"


@query("csv_series_scan", with_inputs("monthly") + """
    SELECT year, month, CAST(NULL AS DOUBLE) AS decimal, average FROM monthly""")
def csv_series_scan(spark, sf_dir):
    path = fresh_path(spark, "series")
    monthly = load(spark, sf_dir, "monthly").select(
        F.col("year").cast("string").alias("year"), F.col("month").cast("string").alias("month"),
        F.lit("").alias("decimal"), F.concat(F.lit("  "), F.col("average").cast("string")).alias("average"),
    )
    note = monthly.select(
        F.concat(F.lit("# series of "), "year").alias("year"), F.lit(None).cast("string").alias("month"),
        F.lit(None).cast("string").alias("decimal"), F.lit(None).cast("string").alias("average"),
    ).distinct()
    monthly.unionByName(note).write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    ddl = "year INT, month INT, decimal DOUBLE, average DOUBLE"
    return readers.read_series(spark, path, ddl)


@query("series_clean", with_inputs("monthly") + f"""
    SELECT gas, year, month, average FROM monthly WHERE {CLEAN}""")
def series_clean(spark, sf_dir):
    clean = series.series_clean(load(spark, sf_dir, "monthly"))
    return clean.select("gas", "year", "month", "average")


@query("annual_mean", with_inputs("monthly") + f"""
    SELECT gas, year, round(avg(average), 6) AS avg_value FROM monthly WHERE {CLEAN} GROUP BY gas, year""")
def annual_mean(spark, sf_dir):
    clean = series.series_clean(load(spark, sf_dir, "monthly"))
    return rounded(series.annual_means(clean, {"average": "avg_value"}, ("gas",)))


@query("annual_deseasonalized_mean", with_inputs("monthly") + f"""
    SELECT gas, year, round(avg(average), 6) AS avg_value, round(avg(deseasonalized), 6) AS avg_deseasonalized
    FROM monthly WHERE {CLEAN} GROUP BY gas, year""")
def annual_deseasonalized_mean(spark, sf_dir):
    clean = series.series_clean(load(spark, sf_dir, "monthly"))
    columns = {"average": "avg_value", "deseasonalized": "avg_deseasonalized"}
    return rounded(series.annual_means(clean, columns, ("gas",)))


TREND_SQL = with_inputs("monthly") + f""",
    annual AS (SELECT gas, year, avg(average) AS y FROM monthly WHERE {CLEAN} GROUP BY gas, year)"""


@query("linear_trend", TREND_SQL + """
    SELECT gas, round(regr_slope(y, year), 4) AS slope,
           round(avg(y) - regr_slope(y, year) * avg(year), 2) AS intercept,
           round(regr_r2(y, year), 4) AS r2, count(*) AS n_years
    FROM annual GROUP BY gas""")
def linear_trend(spark, sf_dir):
    clean = series.series_clean(load(spark, sf_dir, "monthly"))
    annual = series.annual_means(clean, {"average": "y"}, ("gas",))
    trend = series.linear_trend(annual, "y", ("gas",))
    return trend.select(
        "gas", F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"),
        F.round("r2", 4).alias("r2"), "n_years",
    )


@query("linear_trend_ml", with_inputs("monthly") + f""",
    annual AS (SELECT year, avg(average) AS y FROM monthly WHERE {CLEAN} GROUP BY year),
    fit AS (SELECT regr_slope(y, year) AS s, avg(y) AS my, avg(year) AS mx FROM annual)
    SELECT year, round(y, 4) AS y, round(my + s * (year - mx), 3) AS prediction FROM annual, fit""")
def linear_trend_ml(spark, sf_dir):
    clean = series.series_clean(load(spark, sf_dir, "monthly"))
    annual = series.annual_means(clean, {"average": "y"})
    _, predicted = series.linear_trend_model(annual, "y")
    return predicted.select("year", F.round("y", 4).alias("y"), F.round("prediction", 3).alias("prediction"))


@query("union_gas_series", with_inputs("monthly") + """
    SELECT CASE gas WHEN '1-URGENT' THEN 'co2' WHEN '2-HIGH' THEN 'ch4' WHEN '3-MEDIUM' THEN 'n2o'
                    WHEN '4-NOT SPECIFIED' THEN 'sf6' ELSE 'other' END AS gas, year, month, average,
           CASE WHEN gas = '1-URGENT' THEN deseasonalized END AS trend
    FROM monthly""")
def union_gas_series(spark, sf_dir):
    monthly = load(spark, sf_dir, "monthly")
    names = {"1-URGENT": "co2", "2-HIGH": "ch4", "3-MEDIUM": "n2o", "4-NOT SPECIFIED": "sf6"}
    parts = []
    for priority, gas in names.items():
        one = monthly.where(F.col("gas") == priority).drop("gas")
        # the first series alone has a trend column of its own
        parts.append(series.with_gas(one, gas, {"deseasonalized": "trend"}) if gas == "co2" else series.with_gas(
            one.select("year", "month", "average"), gas
        ))
    rest = monthly.where(~F.col("gas").isin(*names) | F.col("gas").isNull()).select("year", "month", "average")
    return readers.union_tables([*parts, series.with_gas(rest, "other")]).select("gas", "year", "month", "average", "trend")


@query("union_parts", """
    SELECT s_name AS name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment FROM supplier
    UNION ALL SELECT c_name, c_acctbal, c_mktsegment FROM customer""")
def union_parts(spark, sf_dir):
    suppliers = ft.project_rename(table(spark, sf_dir, "supplier"), {"s_name": "name", "s_acctbal": "balance"})
    customers = ft.project_rename(
        table(spark, sf_dir, "customer"), {"c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"}
    )
    return readers.union_tables([suppliers, customers])


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("parquet_roundtrip", """
    SELECT p_partkey AS id, p_brand, p_size, p_retailprice FROM part""")
def parquet_roundtrip(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_brand", "p_size", "p_retailprice")
    path = writers.write_parquet(parts, fresh_path(spark, "parts"), ("p_brand",))
    back = spark.read.schema(parts.schema).parquet(path)
    return back.select("id", "p_brand", "p_size", "p_retailprice")


@query("csv_sink", with_inputs("points") + """
    SELECT point_id, round(lon, 6) AS lon, round(lat, 6) AS lat FROM points""")
def csv_sink(spark, sf_dir):
    points = load(spark, sf_dir, "points")
    path = writers.write_csv(points, fresh_path(spark, "points"))
    return rounded(spark.read.csv(path, header=True, schema="point_id BIGINT, lon DOUBLE, lat DOUBLE"))


@query("skip_existing", """
    SELECT o_orderkey, o_orderpriority FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_linenumber = 7)""")
def skip_existing_query(spark, sf_dir):
    todo = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    done = table(spark, sf_dir, "lineitem").where("l_linenumber = 7").select(
        F.col("l_orderkey").alias("o_orderkey")
    )
    return skip_existing(todo, done, ["o_orderkey"])


# ---------------------------------------------------------------- projection and filters

@query("project_rename", "SELECT p_partkey AS OBJECTID, p_brand AS overlay_level2, p_size AS size FROM part")
def project_rename(spark, sf_dir):
    names = {"p_partkey": "OBJECTID", "p_brand": "overlay_level2", "p_size": "size"}
    return ft.project_rename(table(spark, sf_dir, "part"), names)


@query("project_if_present", with_inputs("streets") + """
    SELECT id AS OBJECTID, TrafDir, StreetWidth_Min, StreetWidth_Max, RW_TYPE, Number_Total_Lanes, FeatureTyp,
           SegmentTyp, BIKE_TRAFDIR, feet_x AS XFrom, feet_y AS YFrom, feet_x + feet_dx AS XTo, feet_y + feet_dy AS YTo
    FROM streets""")
def project_if_present(spark, sf_dir):
    from terraquilt.config import STREET_COLUMNS

    return ft.project_if_present(streets(spark, sf_dir), STREET_COLUMNS).drop("geometry")


@query("cast_columns", with_inputs("codes") + """
    SELECT id, TRY_CAST(code AS BIGINT) AS code, CAST(id AS DOUBLE) AS as_double FROM codes""")
def cast_columns(spark, sf_dir):
    codes = load(spark, sf_dir, "codes").withColumn("as_double", F.col("id"))
    return ft.cast_columns(codes, {"code": "bigint", "as_double": "double"})


@query("drop_null_required", with_inputs("buildings") + """
    SELECT id, cnstrct_yr, heightroof FROM buildings WHERE cnstrct_yr IS NOT NULL AND heightroof IS NOT NULL""")
def drop_null_required(spark, sf_dir):
    records = load(spark, sf_dir, "buildings").select("id", "cnstrct_yr", "heightroof")
    return ft.drop_null_required(records, ["cnstrct_yr", "heightroof"])


BUILDING_FILTER_SQL = """
    TRY_CAST(cnstrct_yr AS INT) <= 2021 AND CAST(bin AS INT) // 1000000 IN (1, 2)
    AND TRY_CAST(heightroof AS DOUBLE) >= 12 AND TRY_CAST(feat_code AS INT) IN (1006, 2100)
    AND TRY_CAST(lstmoddate AS TIMESTAMP) < TIMESTAMP '2021-07-24 00:00:00' AND lststatype = 'Constructed'"""


@query("building_attr_filter", with_inputs("buildings") + f"""
    SELECT id, CAST(bin AS INT) AS bin, CAST(cnstrct_yr AS INT) AS cnstrct_yr,
           CAST(heightroof AS DOUBLE) AS heightroof
    FROM buildings WHERE {BUILDING_FILTER_SQL}""")
def building_attr_filter(spark, sf_dir):
    records = load(spark, sf_dir, "buildings")
    typed = ft.cast_columns(records, ft.BUILDING_TYPES).withColumn("lstmoddate", F.try_to_timestamp("lstmoddate"))
    return ft.building_attr_filter(typed).select("id", "bin", "cnstrct_yr", "heightroof")


STREET_FILTER_SQL = """
    FeatureTyp NOT IN ('2', '5', '7', '9', 'F') AND SegmentTyp NOT IN ('G', 'F')
    AND trim(RW_TYPE) NOT IN ('4', '12', '14') AND Status = '2'"""


@query("street_attr_filter", with_inputs("streets") + f"""
    SELECT id AS OBJECTID, FeatureTyp, SegmentTyp, trim(RW_TYPE) AS RW_TYPE FROM streets WHERE {STREET_FILTER_SQL}""")
def street_attr_filter(spark, sf_dir):
    kept = ft.street_attr_filter(streets(spark, sf_dir))
    return kept.select("OBJECTID", "FeatureTyp", "SegmentTyp", "RW_TYPE")


@query("timestamp_cutoff", with_inputs("buildings") + """
    SELECT id, lstmoddate FROM buildings
    WHERE TRY_CAST(lstmoddate AS TIMESTAMP) < TIMESTAMP '2021-07-24 00:00:00'""")
def timestamp_cutoff(spark, sf_dir):
    records = load(spark, sf_dir, "buildings").select("id", "lstmoddate")
    return records.where(ft.before_timestamp(F.col("lstmoddate"), "2021-07-24"))


@query("exclude_ids", "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (44, 944)")
def exclude_ids(spark, sf_dir):
    return ft.exclude_ids(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey", [44, 944])


@query("category_subset", with_inputs("streets") + """
    SELECT trim(RW_TYPE) AS RW_TYPE, count(*) FILTER (TrafDir = 'T') AS two_way, count(*) FILTER (TrafDir = 'W') AS against,
           count(*) FILTER (TrafDir = 'A') AS along, count(*) FILTER (TrafDir = 'P') AS no_cars
    FROM streets GROUP BY 1""")
def category_subset(spark, sf_dir):
    kinds = {"two_way": "T", "against": "W", "along": "A", "no_cars": "P"}
    counts = [F.count_if(F.col("TrafDir") == v).alias(name) for name, v in kinds.items()]
    return streets(spark, sf_dir).groupBy(F.trim("RW_TYPE").alias("RW_TYPE")).agg(*counts)


# ---------------------------------------------------------------- scalar functions

@query("trim_blank_to_null", with_inputs("streets") + """
    SELECT id AS OBJECTID, CAST(NULLIF(trim(Number_Total_Lanes), '') AS DOUBLE) AS lanes,
           CAST(CAST(NULLIF(trim(RW_TYPE), '') AS DOUBLE) AS INT) AS rw_type,
           NULLIF(trim(BIKE_TRAFDIR), '') AS bike
    FROM streets""")
def trim_blank_to_null(spark, sf_dir):
    return streets(spark, sf_dir).select(
        "OBJECTID",
        text.text_to_double(F.col("Number_Total_Lanes")).alias("lanes"),
        text.text_to_double(F.col("RW_TYPE")).cast("int").alias("rw_type"),
        text.blank_to_null(F.col("BIKE_TRAFDIR")).alias("bike"),
    )


@query("code_hierarchy", with_inputs("zones") + """
    SELECT id, ZONEDIST AS zonedist_level3, split_part(ZONEDIST, '-', 1) AS zonedist_level2,
           ZONEDIST[1:1] AS zonedist_level1 FROM zones""")
def code_hierarchy(spark, sf_dir):
    return ft.zoning_levels(load(spark, sf_dir, "zones").select("id", "ZONEDIST"))


@query("overlay_level", with_inputs("zones") + """
    SELECT id, OVERLAY AS overlay_level2, regexp_extract(OVERLAY, '^[^-]*') AS overlay_level1 FROM zones""")
def overlay_level(spark, sf_dir):
    return ft.overlay_levels(load(spark, sf_dir, "zones").select("id", "OVERLAY"))


@query("special_district_level", with_inputs("zones") + """
    SELECT id, SDLBL AS sd_level2,
           CASE WHEN contains(SDLBL, '-') THEN split_part(SDLBL, '-', 1) ELSE SDLBL END AS sd_level1 FROM zones""")
def special_district_level(spark, sf_dir):
    return ft.special_district_levels(load(spark, sf_dir, "zones").select("id", "SDLBL"))


PATTERN_SQL = with_inputs("codes") + """,
    v AS (SELECT id, coalesce(code, 'NA') AS value FROM codes),
    chars AS (SELECT id, value, unnest(regexp_extract_all(value, '[^a-zA-Z0-9\\s]')) AS ch,
                     generate_subscripts(regexp_extract_all(value, '[^a-zA-Z0-9\\s]'), 1) AS pos FROM v),
    counted AS (SELECT id, ch, count(*) AS n, min(pos) AS pos FROM chars GROUP BY id, ch),
    listed AS (SELECT id, string_agg('''' || ch || ''': ' || n, ', ' ORDER BY pos) AS txt FROM counted GROUP BY id),
    described AS (
        SELECT v.id, v.value,
            'Pattern: ' || regexp_replace(value, '[0-9]', 'D', 'g')
            || CASE WHEN txt IS NULL THEN '' ELSE ' | Special chars: {' || txt || '}' END
            || CASE WHEN contains(value, ';') OR contains(value, ',') THEN ' | Multiple values with lengths: ['
                 || array_to_string(list_transform(string_split(value,
                        CASE WHEN contains(value, ';') THEN ';' ELSE ',' END), lambda p: length(trim(p))), ', ')
                 || ']' ELSE '' END AS pattern
        FROM v LEFT JOIN listed USING (id))"""


@query("digit_pattern", PATTERN_SQL + " SELECT id, pattern FROM described")
def digit_pattern(spark, sf_dir):
    return load(spark, sf_dir, "codes").select("id", text.code_pattern(F.col("code")).alias("pattern"))


@query("pattern_count_examples", PATTERN_SQL + """
    SELECT pattern, count(*) AS count, list_sort(list(DISTINCT value))[1:3] AS examples
    FROM described GROUP BY pattern""")
def pattern_count_examples(spark, sf_dir):
    return patterns.pattern_counts(load(spark, sf_dir, "codes"), "code")


@query("pattern_counts_join", PATTERN_SQL + """,
    n AS (SELECT pattern, count(*) AS count FROM described GROUP BY pattern),
    e AS (SELECT pattern, min(value) AS example FROM described GROUP BY pattern)
    SELECT n.pattern, n.count, e.example FROM n JOIN e USING (pattern)""")
def pattern_counts_join(spark, sf_dir):
    counted = patterns.pattern_counts(load(spark, sf_dir, "codes"), "code", examples=1)
    return counted.select("pattern", "count", F.element_at("examples", 1).alias("example"))


@query("patterns_by_frequency", PATTERN_SQL + """
    SELECT pattern, count(*) AS count FROM described GROUP BY pattern ORDER BY count DESC, pattern""")
def patterns_by_frequency(spark, sf_dir):
    counted = patterns.pattern_counts(load(spark, sf_dir, "codes"), "code").select("pattern", "count")
    return patterns.patterns_by_frequency(counted)


@query("suggest_regex", PATTERN_SQL + """,
    masked AS (SELECT DISTINCT pattern, regexp_replace(value, '[0-9]', 'D', 'g') AS m FROM described)
    SELECT pattern, CASE
        WHEN contains(m, ';') THEN '[\\d\\-\\/\\s]+(?:;[\\d\\-\\/\\s]+)+'
        WHEN contains(m, ',') THEN '[\\d\\-\\/\\s]+(?:,[\\d\\-\\/\\s]+)+'
        WHEN contains(m, '-') AND contains(m, '/') THEN '\\d+[\\-\\/]\\d+[\\-\\/]\\d+'
        WHEN contains(m, '-') THEN '\\d+\\-\\d+\\-\\d+'
        WHEN contains(m, '/') THEN '\\d+\\/\\d+\\/\\d+'
        WHEN contains(m, ' ') THEN '\\d+\\s+\\d+\\s+\\d+'
        ELSE '\\d+' END AS suggested_regex FROM masked""")
def suggest_regex(spark, sf_dir):
    counted = patterns.pattern_counts(load(spark, sf_dir, "codes"), "code")
    return patterns.with_suggested_regex(counted).select("pattern", "suggested_regex")


@query("split_longlist", with_inputs("codes") + """
    SELECT id, trim(unnest(string_split(replace(code, ',', ';'), ';'))) AS part FROM codes WHERE code IS NOT NULL""")
def split_longlist(spark, sf_dir):
    codes = load(spark, sf_dir, "codes")
    return codes.where("code IS NOT NULL").select("id", F.explode(text.split_longlist(F.col("code"))).alias("part"))


@query("bearing_class", with_inputs("streets") + """,
    a AS (SELECT id, degrees(atan2(feet_dy, feet_dx)) AS d FROM streets)
    SELECT id AS OBJECTID, CASE floor((CASE WHEN d < 0 THEN d + 360 ELSE d END - 22.5) / 45)
        WHEN 0 THEN 'NE-SW' WHEN 1 THEN 'N-S' WHEN 2 THEN 'NW-SE' WHEN 3 THEN 'NE-SW'
        WHEN 5 THEN 'N-S' WHEN 6 THEN 'NW-SE' ELSE 'E-W' END AS direction FROM a""")
def bearing_class(spark, sf_dir):
    s = load(spark, sf_dir, "streets")
    return s.select(
        F.col("id").alias("OBJECTID"), maths.bearing_class(F.col("feet_dx"), F.col("feet_dy")).alias("direction")
    )


@query("mean_of_two", with_inputs("streets") + """
    SELECT id AS OBJECTID, (StreetWidth_Min + StreetWidth_Max) / 2.0::DOUBLE AS street_width_avg FROM streets""")
def mean_of_two(spark, sf_dir):
    width = maths.mean_of_two(F.col("StreetWidth_Min"), F.col("StreetWidth_Max"))
    return streets(spark, sf_dir).select("OBJECTID", width.alias("street_width_avg"))


@query("clamp", """
    SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'NaN'::DOUBLE WHEN value < 1 THEN 1.0::DOUBLE
        WHEN value > 60 THEN 60.0::DOUBLE ELSE value END AS limited FROM events""")
def clamp(spark, sf_dir):
    value = F.when(F.col("event_id") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", maths.clamp(value, 1, 60).alias("limited"))


@query("safe_ratio", """
    SELECT event_id, round(CASE WHEN event_id % 5 = 0 THEN NULL ELSE value / (event_id % 5) END, 6) AS bare,
           round(value / (event_id % 5 + 1e-10), 3) AS guarded FROM events""")
def safe_ratio(spark, sf_dir):
    bottom = (F.col("event_id") % 5).cast("double")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.round(maths.safe_ratio(F.col("value"), bottom), 6).alias("bare"),
        F.round(maths.safe_ratio(F.col("value"), bottom, maths.EPSILON), 3).alias("guarded"),
    )


@query("json_roundtrip", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events""")
def json_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    parsed = events.select("event_id", F.from_json("props", "k INT").alias("s"))
    again = parsed.select("event_id", F.from_json(F.to_json("s"), "k INT").alias("s"))
    return again.select("event_id", "s.k")


# ---------------------------------------------------------------- categories

@query("label_encode", with_inputs("zones") + """
    SELECT id, CAST(dense_rank() OVER (ORDER BY SDLBL) - 1 AS INT) AS SDLBL,
           CAST(dense_rank() OVER (ORDER BY ZONEDIST) - 1 AS INT) AS ZONEDIST FROM zones""")
def label_encode(spark, sf_dir):
    return labels.label_encode(load(spark, sf_dir, "zones").select("id", "SDLBL", "ZONEDIST"), ["SDLBL", "ZONEDIST"])


@query("group_median_fill", with_inputs("streets") + """,
    w AS (SELECT id, RW_TYPE, (StreetWidth_Min + StreetWidth_Max) / 2.0::DOUBLE AS width FROM streets)
    SELECT id AS OBJECTID, RW_TYPE, round(coalesce(width, median(width) OVER (PARTITION BY RW_TYPE)), 6) AS width
    FROM w""")
def group_median_fill(spark, sf_dir):
    s = streets(spark, sf_dir).select(
        "OBJECTID", "RW_TYPE", maths.mean_of_two(F.col("StreetWidth_Min"), F.col("StreetWidth_Max")).alias("width")
    )
    return rounded(labels.group_median_fill(s, "RW_TYPE", ["width"]))


# ---------------------------------------------------------------- coordinate systems

def plane_sql(lon: str, lat: str) -> tuple[str, str]:
    """EPSG:4326 to EPSG:2263 as SQL expressions."""
    e, n = num(crs.ECC), num(crs.CONE)
    phi = f"radians({lat})"
    t = f"(tan(pi() / 4 - {phi} / 2) / pow((1 - {e} * sin({phi})) / (1 + {e} * sin({phi})), {e} / 2))"
    rho = f"({num(crs.SCALE_FT)} * pow({t}, {n}))"
    theta = f"({n} * (radians({lon}) - {num(crs.ORIGIN_LON)}))"
    return (
        f"({num(crs.FALSE_EASTING_FT)} + {rho} * sin({theta}))",
        f"({num(crs.RHO_ORIGIN_FT)} - {rho} * cos({theta}))",
    )


_PX, _PY = plane_sql("lon", "lat")


@query("to_state_plane", with_inputs("points") + f"""
    SELECT point_id, round({_PX}, 4) AS x, round({_PY}, 4) AS y FROM points""")
def to_state_plane(spark, sf_dir):
    p = load(spark, sf_dir, "points").withColumn("p", F.expr(crs.to_state_plane("lon", "lat")))
    return p.select("point_id", F.round("p.x", 4).alias("x"), F.round("p.y", 4).alias("y"))


@query("from_state_plane", with_inputs("points") + f""",
    feet AS (SELECT point_id, {_PX} AS x, {_PY} AS y, lon, lat FROM points)
    SELECT point_id, round(lon, 8) AS lon, round(lat, 8) AS lat FROM feet WHERE x > 0""")
def from_state_plane(spark, sf_dir):
    p = load(spark, sf_dir, "points").withColumn("p", F.expr(crs.to_state_plane("lon", "lat")))
    back = p.select("point_id", F.expr(crs.from_state_plane("p.x", "p.y")).alias("d"))
    return back.select("point_id", F.round("d.lon", 8).alias("lon"), F.round("d.lat", 8).alias("lat"))


@query("web_mercator", with_inputs("points") + """
    SELECT point_id, round(6378137 * radians(lon), 4) AS x, round(6378137 * asinh(tan(radians(lat))), 4) AS y,
           round(lon, 8) AS lon, round(lat, 8) AS lat FROM points""")
def web_mercator(spark, sf_dir):
    p = load(spark, sf_dir, "points").withColumn("m", F.expr(crs.to_web_mercator("lon", "lat")))
    p = p.withColumn("d", F.expr(crs.from_web_mercator("m.x", "m.y")))
    return p.select(
        "point_id", F.round("m.x", 4).alias("x"), F.round("m.y", 4).alias("y"),
        F.round("d.lon", 8).alias("lon"), F.round("d.lat", 8).alias("lat"),
    )
