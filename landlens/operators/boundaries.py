"""Validity of boundary polygons (S9): closure, number of points, orientation, and self-intersection of rings.

A ring crosses itself if two of its segments meet that do not follow each other, or a
segment turns back on the one before.  Testing all pairs of a ring is quadratic, so a
ring's box is divided into a grid of about as many cells as the ring has segments; every
segment goes into the cells that its own box covers, and only segments of one cell are
tested with each other.  Cells are rows and the pairs an equi-join, so a
boundary with millions of points is shared out over the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landlens.sources.readers import parse_polygons

#: Why a boundary can't be used, in the order in which reasons are looked for.
REASONS = ("unreadable", "too_few_points", "unclosed", "self_intersecting")


def _any_ring(polygons: str, test) -> Column:
    return F.exists(polygons, lambda polygon: F.exists(polygon, test))


def _last(ring: Column) -> Column:
    return F.get(ring, F.size(ring) - 1)


def _distinct_points(ring: Column) -> Column:
    """The ring without points that repeat the one before."""
    return F.filter(ring, lambda p, i: (i == 0) | (p != F.get(ring, i - 1)))


def signed_area(ring: Column) -> Column:
    """Twice the area of a closed ring, positive if it runs counter-clockwise."""
    x0, y0 = F.get(ring, F.lit(0))["x"], F.get(ring, F.lit(0))["y"]
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    cross = F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), lambda p, q: (p["x"] - x0) * (q["y"] - y0) - (q["x"] - x0) * (p["y"] - y0))
    return F.aggregate(cross, F.lit(0.0), lambda a, c: a + c)


def reversed_rings(polygons: Column) -> Column:
    """Number of rings that run the wrong way round: outer rings clockwise, or holes counter-clockwise."""
    wrong = F.transform(polygons, lambda polygon: F.size(F.filter(polygon, lambda ring, i: F.when(i == 0, signed_area(ring) < 0).otherwise(signed_area(ring) > 0))))
    return F.aggregate(wrong, F.lit(0), lambda a, n: a + n)


def segments(rings: DataFrame, key: str, ring: str) -> DataFrame:
    """key, i, n, ax, ay, bx, by of the segments of closed rings; ``key`` names a ring."""
    points = rings.select(key, _distinct_points(F.col(ring)).alias("p"))
    n = F.greatest(F.size("p") - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice("p", F.lit(1), n).alias("a"), F.slice("p", F.lit(2), n).alias("b"))
    s = points.select(key, n.alias("n"), F.posexplode(pairs).alias("i", "s"))
    return s.select(key, "i", "n", F.col("s.a.x").alias("ax"), F.col("s.a.y").alias("ay"), F.col("s.b.x").alias("bx"), F.col("s.b.y").alias("by"))


def _turn(a: str, b: str, c: str) -> Column:
    """Sign of the turn from a to b to c (names of points: prefix_end)."""
    (ax, ay), (bx, by), (cx, cy) = ((F.col(f"{p}x"), F.col(f"{p}y")) for p in (a, b, c))
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def _boxes_meet() -> Column:
    def side(k: str) -> Column:
        low = {s: F.least(f"{s}a{k}", f"{s}b{k}") for s in "st"}
        high = {s: F.greatest(f"{s}a{k}", f"{s}b{k}") for s in "st"}
        return (low["s"] <= high["t"]) & (low["t"] <= high["s"])

    return side("x") & side("y")


def crossing_rings(rings: DataFrame, key: str = "ring_key", ring: str = "ring") -> DataFrame:
    """The keys of closed rings that cross or touch themselves."""
    s = segments(rings, key, ring)
    box = s.groupBy(key).agg(F.min(F.least("ax", "bx")).alias("x0"), F.min(F.least("ay", "by")).alias("y0"),
                             F.max(F.greatest("ax", "bx")).alias("x1"), F.max(F.greatest("ay", "by")).alias("y1"), F.ceil(F.sqrt(F.count(F.lit(1)))).alias("g"))
    s = s.join(box, key)

    def cells(k: str) -> Column:
        def cell(v: Column) -> Column:
            return F.least(F.floor(F.coalesce(F.try_divide((v - F.col(f"{k}0")) * F.col("g"), F.col(f"{k}1") - F.col(f"{k}0")), F.lit(0.0))), F.col("g") - 1)

        return F.sequence(cell(F.least(f"a{k}", f"b{k}")), cell(F.greatest(f"a{k}", f"b{k}")))

    placed = s.withColumn("cx", F.explode(cells("x"))).withColumn("cy", F.explode(cells("y"))).drop("x0", "y0", "x1", "y1", "g")
    coordinates = ("ax", "ay", "bx", "by")
    one = placed.select(key, "cx", "cy", "n", F.col("i").alias("si"), *[F.col(c).alias(f"s{c}") for c in coordinates])
    other = placed.select(key, "cx", "cy", F.col("i").alias("ti"), *[F.col(c).alias(f"t{c}") for c in coordinates])
    pairs = one.join(other, [key, "cx", "cy"]).where(F.col("si") < F.col("ti"))
    follows = F.col("ti") == F.col("si") + 1
    closes = (F.col("si") == 0) & (F.col("ti") == F.col("n") - 1)

    def back(a: str, b: str, d: str) -> Column:
        """b to d runs back over a to b."""
        toward = (F.col(f"{a}x") - F.col(f"{b}x")) * (F.col(f"{d}x") - F.col(f"{b}x")) + (F.col(f"{a}y") - F.col(f"{b}y")) * (F.col(f"{d}y") - F.col(f"{b}y"))
        return (_turn(a, b, d) == 0) & (toward > 0)

    meet = _boxes_meet() & (_turn("sa", "sb", "ta") * _turn("sa", "sb", "tb") <= 0) & (_turn("ta", "tb", "sa") * _turn("ta", "tb", "sb") <= 0)
    fault = F.when(follows & closes, F.lit(True)).when(follows, back("sa", "sb", "tb")).when(closes, back("ta", "tb", "sb")).otherwise(meet)
    return pairs.where(fault).select(key).distinct()


def check_boundaries(df: DataFrame, name_col: str = "name", geojson_col: str = "geojson") -> DataFrame:
    """(name, polygons, reason, reversed_rings) of every row: ``reason`` is the first of ``REASONS`` that holds, null for a usable boundary.

    A ring is closed if its last point is its first; it needs three different
    points.  Rings that run the wrong way round are counted, not rejected.
    ``polygons`` is null where the text is unreadable.
    """
    read = df.select(F.col(name_col).alias("name"), F.md5(F.col(geojson_col)).alias("__text"), parse_polygons(F.col(geojson_col)).alias("polygons"))
    whole = (F.size("polygons") > 0) & F.forall("polygons", lambda polygon: (F.size(polygon) > 0) & F.forall(
        polygon, lambda ring: F.forall(ring, lambda p: p["x"].isNotNull() & p["y"].isNotNull())))
    few = _any_ring("polygons", lambda ring: F.size(F.array_distinct(ring)) < 3)
    open_ = _any_ring("polygons", lambda ring: F.get(ring, F.lit(0)) != _last(ring))
    plain = F.when(~F.coalesce(whole, F.lit(False)), "unreadable").when(few, "too_few_points").when(open_, "unclosed")
    read = read.withColumn("__plain", plain).withColumn("polygons", F.when(F.col("__plain").isNull() | (F.col("__plain") != "unreadable"), F.col("polygons")))
    rings = read.where(F.col("__plain").isNull()).dropDuplicates(["__text"]).select("__text", F.posexplode("polygons").alias("a", "polygon"))
    rings = rings.select("__text", "a", F.posexplode("polygon").alias("b", "ring")).select(F.struct("__text", "a", "b").alias("ring_key"), "ring")
    crossing = crossing_rings(rings).select(F.col("ring_key.__text").alias("__text")).distinct().withColumn("__crosses", F.lit(True))
    out = read.join(crossing, "__text", "left")
    reason = F.coalesce(F.col("__plain"), F.when(F.col("__crosses"), "self_intersecting"))
    return out.select("name", "polygons", reason.alias("reason"), F.when(F.col("polygons").isNotNull(), reversed_rings(F.col("polygons"))).otherwise(0).alias("reversed_rings"))
