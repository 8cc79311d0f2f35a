"""Column expressions on literal rows (edge cases from the fixture notes)."""

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landlens.contracts import POSTAL_CODE_PATTERN, USE_POSTAL, USE_POSTAL_DEFAULT, ZONING_POSTAL
from landlens.functions import (
    class_of, extract_pattern, indicator, lonlat_to_utm, normalise_names, percent_change,
    point_part, ring_centroid, safe_corr, share_percent, to_int, truncate, two_digit_year,
)


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


def test_class_of_zoning_postal(spark):
    vals = ["One-Family Dwelling", "Comprehensive Development", "Multiple Dwelling", "Nope", None]
    df = one_col(spark, vals).select(class_of("v", ZONING_POSTAL, "unknown").alias("c"))
    assert [r.c for r in df.collect()] == ["residential", "mixed", "non-residential", "unknown", "unknown"]


def test_use_postal_from_max_text(spark):
    # lexicographic max decides: 'Office Uses' > 'Dwelling Uses', 'Agricultural Uses' < 'Dwelling Uses'
    df = spark.createDataFrame([("a", "Agricultural Uses"), ("a", "Dwelling Uses"),
                                ("b", "Office Uses"), ("b", "Dwelling Uses"), ("c", None)], "p string, u string")
    g = df.groupBy("p").agg(class_of(F.max("u"), USE_POSTAL, USE_POSTAL_DEFAULT).alias("c"))
    assert dict((r.p, r.c) for r in g.collect()) == {"a": "residential", "b": "non-residential",
                                                      "c": "non-residential"}


def test_indicator_null_is_zero(spark):
    df = one_col(spark, ["x", "y", None]).select(indicator("v", ["x"]).alias("i"))
    assert [r.i for r in df.collect()] == [1, 0, 0]


def test_to_int_two_step(spark):
    df = one_col(spark, ["3.0", "3.9", "-3.9", "x", "99999999999", None, "12"])
    got = [r.i for r in df.select(to_int(F.col("v")).alias("i")).collect()]
    assert got == [3, 3, -3, None, None, None, 12]


def test_percent_change_published_row(spark):
    # first row of the published area follow-up file: 7425586015 -> 6804464015 is -8.36 %
    df = spark.createDataFrame([(Decimal("7425586015.00"), Decimal("6804464015.00")),
                                (Decimal("0.00"), Decimal("5.00")),
                                (Decimal("200.00"), Decimal("200.01"))],
                               "b decimal(28,2), f decimal(28,2)")
    got = [r.p for r in df.select(percent_change(F.col("b"), F.col("f")).alias("p")).collect()]
    assert got[0] == Decimal("-8.36")
    assert got[1] is None
    assert got[2] == Decimal("0.01")     # 0.005 rounds half up


def test_two_digit_year(spark):
    df = one_col(spark, [16, 24, None], "int").select(two_digit_year(F.col("v")).alias("y"))
    assert [r.y for r in df.collect()] == [2016, 2024, None]


def test_point_part_cases(spark):
    vals = ["49.2, -123.1", "49.2", "49.2,-123.1,7", "x, y", None, " 49.25 ,-123.5 "]
    df = one_col(spark, vals).select(point_part(F.col("v"), 1).alias("lat"),
                                     point_part(F.col("v"), 2).alias("lon"))
    got = [(r.lat, r.lon) for r in df.collect()]
    assert got == [(49.2, -123.1), (None, None), (None, None), (None, None), (None, None),
                   (49.25, -123.5)]


def test_truncate_keeps_null_and_short(spark):
    vals = ["a" * 300, "b" * 255, None, "é" * 300]
    got = [r.t for r in one_col(spark, vals).select(truncate(F.col("v"), 255).alias("t")).collect()]
    assert [None if t is None else len(t) for t in got] == [255, 255, None, 255]
    assert got[1] == "b" * 255


def test_postal_code_extraction(spark):
    vals = ["123 Main St, Centre City V6E 3T1", "v6e 3t1 lower", "V5K 0A1 then V6B 1A1",
            "no code here", None]
    df = one_col(spark, vals).select(extract_pattern(F.col("v"), POSTAL_CODE_PATTERN, 0).alias("p"))
    assert [r.p for r in df.collect()] == ["V6E 3T1", "v6e 3t1", "V5K 0A1", "", None]


def test_normalise_names_only_listed(spark):
    vals = ["North-Hill", "South-Bank", None]
    df = one_col(spark, vals).select(normalise_names(F.col("v"), ["North-Hill"]).alias("n"))
    assert [r.n for r in df.collect()] == ["North Hill", "South-Bank", None]


def test_share_percent(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (2, 0)], "a long, b long")
    got = [r.s for r in df.select(share_percent(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got == [25.0, None, 100.0]


def test_safe_corr_guards(spark):
    df = spark.createDataFrame([("const", 1.0, 5.0), ("const", 2.0, 5.0), ("one", 1.0, 2.0),
                                ("lin", 1.0, 2.0), ("lin", 2.0, 4.0), ("lin", 3.0, 6.1)],
                               "g string, x double, y double")
    got = {r.g: r.c for r in df.groupBy("g").agg(safe_corr(F.col("x"), F.col("y")).alias("c")).collect()}
    assert got["const"] is None and got["one"] is None
    assert got["lin"] == pytest.approx(0.99986, abs=1e-4)


def _ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


RING_T = "ring array<struct<x:double,y:double>>"


def test_centroid_shapes(spark):
    box = _ring([(0, 0), (4, 0), (4, 2), (0, 2)])                       # open
    box_closed = _ring([(0, 0), (4, 0), (4, 2), (0, 2), (0, 0)])
    box_cw = _ring([(0, 0), (0, 2), (4, 2), (4, 0)])                    # reversed orientation
    ell = _ring([(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2)])       # L-shape, area 3
    far = _ring([(500000, 5400000), (500004, 5400000), (500004, 5400002), (500000, 5400002)])
    df = spark.createDataFrame([(r,) for r in (box, box_closed, box_cw, ell, far)], RING_T)
    got = [(r.c.x, r.c.y, r.c.area) for r in df.select(ring_centroid(F.col("ring")).alias("c")).collect()]
    for x, y, a in got[:3]:
        assert (x, y, a) == pytest.approx((2.0, 1.0, 8.0))
    # L-shape: centroid of unit squares (0.5,0.5),(1.5,0.5),(0.5,1.5)
    assert got[3] == pytest.approx((5 / 6, 5 / 6, 3.0))
    assert got[4] == pytest.approx((500002.0, 5400001.0, 8.0))


def test_utm_projection_known_values(spark):
    df = spark.createDataFrame([(-123.0, 45.0), (-123.0, 0.0), (-122.0, 49.0), (-124.0, 49.0)],
                               "lon double, lat double")
    got = [(r.p.x, r.p.y) for r in df.select(lonlat_to_utm(F.col("lon"), F.col("lat")).alias("p")).collect()]
    # on the central meridian: easting 500 km, northing = k0 * meridian arc (4 984 944.378 m at 45 deg)
    assert got[0][0] == pytest.approx(500000.0, abs=1e-6)
    assert got[0][1] == pytest.approx(0.9996 * 4984944.378, abs=1.0)
    assert got[1] == pytest.approx((500000.0, 0.0), abs=1e-6)
    # symmetric about the central meridian
    assert got[2][0] - 500000 == pytest.approx(500000 - got[3][0], abs=1e-6)
    assert got[2][1] == pytest.approx(got[3][1], abs=1e-6)
    # one degree of longitude at 49 N is about 73 km
    assert 72000 < got[2][0] - 500000 < 74000
    assert not math.isnan(got[2][1])


def test_conform_column_types(spark):
    from landlens.functions.casts import conform_column
    df = spark.createDataFrame([("2020-01-05", "12", "1e3", "abc")], "d string, a string, b string, c string")
    r = df.select(conform_column(F.col("d"), T.DateType(), T.StringType()).alias("d"),
                  conform_column(F.col("a"), T.DecimalType(18, 2), T.StringType()).alias("a"),
                  conform_column(F.col("b"), T.DecimalType(18, 2), T.StringType()).alias("b"),
                  conform_column(F.col("c"), T.DateType(), T.StringType()).alias("c")).first()
    assert str(r.d) == "2020-01-05" and r.a == Decimal("12.00") and r.b == Decimal("1000.00")
    assert r.c is None


def test_ratios_are_rounded_once_and_never_raise(spark):
    from landlens.functions.numeric import finish_avg, round_ratio
    big = "123456789012345678901234567890.12"
    rows = [("100000.00", "20000001", "0.00"), ("0.05", "10", "0.01"), ("-0.05", "10", "-0.01"), ("0.04", "10", "0.00"), ("1.00", "3", "0.33"),
            ("2.00", "-3", "-0.67"), (big, "1", big), ("1.00", "0", None), (None, "1", None)]
    df = spark.createDataFrame([(a and Decimal(a), Decimal(b)) for a, b, _ in rows], "a decimal(38,2), b decimal(20,0)")
    want = [w and Decimal(w) for _, _, w in rows]
    assert [r.q for r in df.select(finish_avg(F.col("a"), F.col("b")).alias("q")).collect()] == want
    assert [r.q for r in df.select(round_ratio(F.col("a"), F.col("b")).alias("q")).collect()] == want
    ends = spark.createDataFrame([(Decimal("1.00"), Decimal(3 * 10**18)), (Decimal(3 * 10**18), Decimal("1.00")), (Decimal("0.01"), Decimal(10**35))],
                                 "b decimal(38,2), f decimal(38,2)")
    got = [r.p for r in ends.select(percent_change(F.col("b"), F.col("f")).alias("p")).collect()]
    assert got[:2] == [Decimal(3 * 10**20 - 100), Decimal("-100.00")] and got[2] is None      # beyond 38 digits


def test_text_to_integer_truncates(spark):
    from landlens.functions.casts import to_int
    df = spark.createDataFrame([("3.9999999",), ("-3.9999999999999999",), ("2147483647.9",), ("2147483648",), ("x",), (None,), ("1e2",)], "t string")
    assert [r.i for r in df.select(to_int(F.col("t"), T.StringType()).alias("i")).collect()] == [3, -3, 2147483647, None, None, None, 100]
    long = df.select(to_int(F.col("t"), T.StringType(), T.LongType()).alias("i"))
    assert [r.i for r in long.collect()] == [3, -3, 2147483647, 2147483648, None, None, 100]
