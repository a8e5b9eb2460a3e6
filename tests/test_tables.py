"""Series, text, category and feature rules."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terraquilt.config import SERIES_DDL, JobConfig
from terraquilt.functions import indices, maths, text
from terraquilt.operators import features, labels, patterns, sampling, series
from terraquilt.sources import readers
from terraquilt.streaming import skip_existing


def test_series_file_with_preamble(spark, tmp_path):
    preamble = "\n".join(f"# note {i}" for i in range(45))
    body = "1983,7,1983.542,1625.95,2.50,1635.06,2.00\n1983,8,1983.625,1628.05,-9.99,1635.69,-9.99\n"
    path = tmp_path / "gas.csv"
    path.write_text(f"{preamble}\nyear,month,decimal,average,average_unc,trend,trend_unc\n\n{body}")
    rows = readers.read_series(spark, str(path), SERIES_DDL["ch4"])
    assert rows.count() == 2
    clean = readers.missing_uncertainty_to_null(rows, ["average_unc", "trend_unc"]).orderBy("month").collect()
    assert clean[0].average_unc == 2.5 and clean[1].average_unc is None and clean[1].trend_unc is None


def test_multiline_records(spark, tmp_path):
    path = tmp_path / "records.json"
    path.write_text('[\n {"bin": "1", "h": "12.5"},\n {"bin": "2"}\n]')
    rows = readers.read_records(spark, str(path), "bin STRING, h STRING").orderBy("bin").collect()
    assert [(r.bin, r.h) for r in rows] == [("1", "12.5"), ("2", None)]


def test_trend_equals_model(spark):
    annual = spark.createDataFrame([(y, 300 + 1.5 * (y - 1960) + (y % 3)) for y in range(1960, 2000)], "year int, v double")
    line = series.linear_trend(annual, "v").first()
    model, predicted = series.linear_trend_model(annual, "v")
    assert line.slope == pytest.approx(model.coefficients[0], rel=1e-8)
    assert line.intercept == pytest.approx(model.intercept, rel=1e-8)
    assert line.r2 == pytest.approx(model.summary.r2, rel=1e-8)
    assert predicted.where("year = 1990").first().prediction == pytest.approx(line.slope * 1990 + line.intercept)


CODES = [
    "1000010010", "1-00001-0010", "1/00001/0010", "1000010010;1000010011", "1000010010, 1000010011",
    "1 00001 0010", "it's\\odd?", "", "a-b/c;d, e", None, "Customer#7",
]


def described(value):
    """Descriptor of one code, straight from the definition."""
    value = "NA" if value is None else value
    out = "Pattern: " + re.sub(r"\d", "D", value)
    specials = re.findall(r"[^a-zA-Z0-9\s]", value)
    if specials:
        out += f" | Special chars: {dict(Counter(specials))}"
    if ";" in value or "," in value:
        parts = value.split(";" if ";" in value else ",")
        out += f" | Multiple values with lengths: {[len(p.strip()) for p in parts]}"
    return out


def test_code_patterns(spark):
    df = spark.createDataFrame([(c,) for c in CODES], "code string")
    for r in df.select("code", text.code_pattern(F.col("code")).alias("p")).collect():
        assert r.p == described(r.code)


def test_suggested_regex_compat(spark):
    df = spark.createDataFrame([("123",), ("1 2 3",), ("1-2-3",)], "code string").withColumn("p", text.code_pattern(F.col("code")))
    fixed = {r.code: r.s for r in df.select("code", text.suggested_regex(F.col("p")).alias("s")).collect()}
    assert fixed == {"123": text.DIGITS, "1 2 3": text.SPACE, "1-2-3": text.HYPHEN}
    compat = {r.code: r.s for r in df.select("code", text.suggested_regex(F.col("p"), compat=True).alias("s")).collect()}
    assert compat["123"] == text.SPACE


def test_pattern_examples_are_bounded_and_ordered(spark):
    df = spark.createDataFrame([(f"{i:04d}",) for i in range(500)] + [("0001",)] * 300, "code string")
    r = patterns.pattern_counts(df, "code").first()
    assert r["count"] == 800 and r.examples == ["0000", "0001", "0002"]


def test_label_codes_follow_byte_order(spark):
    values = ["MiD", "MX-9", "125th", "C", None, "MX-9"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, c string")
    few = {r.id: r.c for r in labels.label_encode(df, ["c"]).collect()}
    assert few == {0: 3, 1: 2, 2: 0, 3: 1, 4: None, 5: 2}


def test_many_labels_are_dense(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 3001).cast("string").alias("c"), "id")
    rows = labels.label_encode(df, ["c"]).join(df.withColumnRenamed("c", "text"), "id").collect()
    expected = {v: i for i, v in enumerate(sorted({r.text for r in rows}))}
    assert all(r.c == expected[r.text] for r in rows)


def test_group_median_fill(spark):
    rows = [("a", 1.0, None), ("a", 2.0, 5.0), ("a", None, 7.0), ("b", None, None), (None, 4.0, 1.0), (None, None, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = sorted(labels.group_median_fill(df, "g", ["x", "y"]).collect(), key=str)
    assert sorted([("a", 1.0, 6.0), ("a", 2.0, 5.0), ("a", 1.5, 7.0), ("b", None, None), (None, 4.0, 1.0), (None, 4.0, 1.0)], key=str) == sorted(
        [tuple(r) for r in got], key=str
    )


def test_bearing_sector_edges(spark):
    import math

    cases = {0: "E-W", 22.4: "E-W", 22.6: "NE-SW", 67.6: "N-S", 112.6: "NW-SE", 157.6: "NE-SW", 202.6: "E-W",
             247.4: "E-W", 247.6: "N-S", 292.6: "NW-SE", 337.6: "E-W"}
    rows = [(float(a), math.cos(math.radians(a)), math.sin(math.radians(a))) for a in cases] + [(-1.0, None, 1.0)]
    df = spark.createDataFrame(rows, "a double, dx double, dy double")
    got = {r.a: r.c for r in df.select("a", maths.bearing_class(F.col("dx"), F.col("dy")).alias("c")).collect()}
    assert got == {**{float(a): c for a, c in cases.items()}, -1.0: "E-W"}


def test_clamp_keeps_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (-3.0,), (0.5,), (9.0,), (None,)], "v double")
    got = [r.c for r in df.select(maths.clamp(F.col("v"), 0, 1).alias("c")).collect()]
    assert got[0] != got[0] and got[1:] == [0.0, 0.5, 1.0, None]


def test_null_policy_of_not_in(spark):
    df = spark.createDataFrame([("2",), ("0",), (None,)], "v string")
    assert df.where(features.not_in(F.col("v"), ["2"])).count() == 1
    assert df.where(features.not_in(F.col("v"), ["2"], "keep")).count() == 2
    with pytest.raises(ValueError):
        features.not_in(F.col("v"), ["2"], "ignore")


def test_unreadable_text_is_null_not_an_error(spark):
    df = spark.createDataFrame([("12", " 3.5 "), ("x", "  "), (None, None)], "a string, b string")
    got = features.cast_columns(df, {"a": "int"}).withColumn("b", text.text_to_double(F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(12, 3.5), (None, None), (None, None)]


def test_special_district_without_dash(spark):
    df = spark.createDataFrame([("MX-9",), ("MiD",)], "SDLBL string")
    assert {r.sd_level1 for r in features.special_district_levels(df).collect()} == {"MX", "MiD"}


def test_indices_ignore_zero_division(spark):
    df = spark.createDataFrame([(0.0,) * 6], "red double, blue double, green double, nir double, swir16 double, swir22 double")
    values = indices.spectral_indices({c: F.col(c) for c in df.columns})
    row = df.select(*[e.alias(n) for n, e in values.items()]).first()
    assert row.ndvi is None and row.evi == 0.0 and row.gndvi == 0.0
    assert set(values) == set(indices.INDEX_NAMES)


def test_feature_names():
    assert sampling.feature_names(["aod55"], (1, 7)) == [
        "aod55", "aod55_mean_15x15", "aod55_mean_3x3", "aod55_std_dev_15x15", "aod55_std_dev_3x3",
    ]


def test_skip_existing(spark):
    todo, done = spark.range(5), spark.range(2, 4)
    assert {r.id for r in skip_existing(todo, done, ["id"]).collect()} == {0, 1, 4}


def test_catalogue_names_its_inputs():
    cfg = JobConfig(catalogue={"street": "hdfs://nn/streets"})
    assert cfg.path("street") == "hdfs://nn/streets"
    with pytest.raises(KeyError, match="building"):
        cfg.path("building")
