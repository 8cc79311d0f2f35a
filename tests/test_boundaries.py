"""Validity of boundary rings."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from landlens.operators.boundaries import check_boundaries, crossing_rings, reversed_rings

SQUARE = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
BOW_TIE = [[0, 0], [4, 4], [4, 0], [0, 4], [0, 0]]
SPIKE = [[0, 0], [4, 0], [4, 4], [4, 9], [4, 4], [0, 4], [0, 0]]
TOUCH = [[0, 0], [4, 0], [4, 4], [2, 0], [0, 4], [0, 0]]
HOLE = [[1, 1], [1, 2], [2, 2], [2, 1], [1, 1]]
SHAPES = {
    "square": ("Polygon", [SQUARE], None, 0),
    "hole": ("Polygon", [SQUARE, HOLE], None, 0),
    "reversed": ("Polygon", [SQUARE[::-1], HOLE[::-1]], None, 2),
    "l-shape": ("Polygon", [[[0, 0], [4, 0], [4, 1], [1, 1], [1, 4], [0, 4], [0, 0]]], None, 0),
    "unclosed": ("Polygon", [SQUARE[:-1]], "unclosed", 0),
    "bow-tie": ("Polygon", [BOW_TIE], "self_intersecting", 0),
    "spike": ("Polygon", [SPIKE], "self_intersecting", 0),
    "touch": ("Polygon", [TOUCH], "self_intersecting", 0),
    "bad hole": ("Polygon", [SQUARE, BOW_TIE], "self_intersecting", 0),
    "second part": ("MultiPolygon", [[SQUARE], [BOW_TIE]], "self_intersecting", 0),
    "parts": ("MultiPolygon", [[SQUARE], [[[9, 9], [10, 9], [10, 10], [9, 9]]]], None, 0),
    "two points": ("Polygon", [[[0, 0], [1, 1], [0, 0]]], "too_few_points", 0),
    "repeated points": ("Polygon", [[[0, 0], [0, 0], [4, 0], [4, 4], [4, 4], [0, 4], [0, 0]]], None, 0),
    "line": ("LineString", [[0, 0], [1, 1]], "unreadable", 0),
    "no number": ("Polygon", [[[0, 0], [1], [1, 1], [0, 0]]], "unreadable", 0),
    "no ring": ("Polygon", [], "unreadable", 0),
}


def test_reasons_and_orientation(spark):
    rows = [(n, json.dumps({"type": t, "coordinates": c})) for n, (t, c, _, _) in SHAPES.items()] + [("text", "no json"), ("null", None), ("square", json.dumps({"type": "Polygon", "coordinates": [SQUARE]}))]
    got = {(r.name, r.reason, r.reversed_rings, r.polygons is None) for r in check_boundaries(spark.createDataFrame(rows, "name string, geojson string")).collect()}
    want = {(n, reason, turned, reason == "unreadable") for n, (_, _, reason, turned) in SHAPES.items()} | {("text", "unreadable", 0, True), ("null", "unreadable", 0, True)}
    assert got == want
    assert check_boundaries(spark.createDataFrame(rows, "name string, geojson string")).count() == len(rows)


def turn(a, b, c):
    v = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    return (v > 0) - (v < 0)


def crosses(ring):
    """All pairs of segments."""
    p = [q for i, q in enumerate(ring) if i == 0 or q != ring[i - 1]]
    s = list(zip(p, p[1:]))
    for i, (a, b) in enumerate(s):
        for j in range(i + 1, len(s)):
            c, d = s[j]
            if j == i + 1 or (i == 0 and j == len(s) - 1):
                (a2, b2, d2) = (a, b, d) if j == i + 1 else (c, d, b)
                if turn(a2, b2, d2) == 0 and (a2[0] - b2[0]) * (d2[0] - b2[0]) + (a2[1] - b2[1]) * (d2[1] - b2[1]) > 0:
                    return True
                continue
            boxes = all(min(a[k], b[k]) <= max(c[k], d[k]) and min(c[k], d[k]) <= max(a[k], b[k]) for k in (0, 1))
            if boxes and turn(a, b, c) * turn(a, b, d) <= 0 and turn(c, d, a) * turn(c, d, b) <= 0:
                return True
    return False


def random_ring(rng, n, noise):
    """A star-shaped ring; with noise its points are swapped now and then."""
    points = []
    for k in range(n):
        r, t = rng.uniform(5, 10), 2 * math.pi * k / n
        points.append((round(r * math.cos(t), 3), round(r * math.sin(t), 3)))
    for _ in range(noise):
        i = rng.randrange(n - 1)
        points[i], points[i + 1] = points[i + 1], points[i]
    return [*points, points[0]]


def test_crossings_equal_all_pairs(spark):
    rng = random.Random(4)
    rings = [random_ring(rng, rng.randint(4, 60), rng.choice([0, 0, 1, 2])) for _ in range(120)]
    rings += [[(rng.randint(0, 4), rng.randint(0, 4)) for _ in range(rng.randint(3, 6))] for _ in range(150)]  # on a lattice: touching, collinear
    rings = [r if r[0] == r[-1] else [*r, r[0]] for r in rings]
    rings = [r for r in rings if len(set(r)) >= 3]
    df = spark.createDataFrame([(i, [{"x": float(x), "y": float(y)} for x, y in r]) for i, r in enumerate(rings)], "ring_key int, ring array<struct<x:double,y:double>>")
    got = {r.ring_key for r in crossing_rings(df).collect()}
    want = {i for i, r in enumerate(rings) if crosses(r)}
    assert got == want and 20 < len(want) < len(rings) - 20


def test_a_long_ring_is_tested_by_cells(spark):
    n = 20_000
    angle = 2 * math.pi * F.col("id") / n
    points = spark.range(n + 1).select(F.struct((F.cos(angle) * 10).alias("x"), (F.sin(angle) * 10).alias("y")).alias("p"), "id")
    ring = points.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", "p"))), lambda s: s["p"]).alias("ring")).withColumn("ring", F.concat(F.slice("ring", 1, n), F.slice("ring", 1, 1)))
    assert crossing_rings(ring.withColumn("ring_key", F.lit(1))).collect() == []
    tied = ring.withColumn("ring", F.transform("ring", lambda p, i: F.when(i == 777, F.get("ring", F.lit(12_345))).otherwise(p)))
    assert [r[0] for r in crossing_rings(tied.withColumn("ring_key", F.lit(1))).collect()] == [1]


@pytest.mark.parametrize("ring, wrong", [(SQUARE, 0), (SQUARE[::-1], 1)])
def test_orientation_of_an_outer_ring(spark, ring, wrong):
    df = spark.createDataFrame([([[[{"x": float(x), "y": float(y)} for x, y in ring]]],)], "p array<array<array<struct<x:double,y:double>>>>")
    assert df.select(reversed_rings(F.col("p"))).first()[0] == wrong
