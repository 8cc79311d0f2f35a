"""Geometry as Column arithmetic: reprojection and polygon centroids.

Rings are ``ARRAY<STRUCT<x DOUBLE, y DOUBLE>>`` (lon/lat before projection),
closed or not; a polygon is its outer ring and then its holes.  Everything runs inside Catalyst's higher-order functions, so
no geometry library and no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# GRS80 ellipsoid and UTM zone 10 north (EPSG:26910).
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM10_CENTRAL_MERIDIAN = -123.0


def lonlat_to_utm(lon: Column, lat: Column, central_meridian: float = UTM10_CENTRAL_MERIDIAN,
                  a: float = GRS80_A, inv_f: float = GRS80_INV_F, k0: float = UTM_K0,
                  false_easting: float = UTM_FALSE_EASTING) -> Column:
    """Transverse Mercator (published series, northern hemisphere) -> struct(x, y) in metres.

    Accurate to millimetres within a few degrees of the central meridian.
    """
    f = 1.0 / inv_f
    e2 = 2 * f - f * f
    ep2 = e2 / (1 - e2)
    e4, e6 = e2 * e2, e2 * e2 * e2
    m1 = 1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256
    m2 = 3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024
    m3 = 15 * e4 / 256 + 45 * e6 / 1024
    m4 = 35 * e6 / 3072

    phi = F.radians(lat)
    sin_phi, cos_phi, tan_phi = F.sin(phi), F.cos(phi), F.tan(phi)
    n = F.lit(a) / F.sqrt(F.lit(1.0) - F.lit(e2) * sin_phi * sin_phi)
    t = tan_phi * tan_phi
    c = F.lit(ep2) * cos_phi * cos_phi
    aa = F.radians(lon - F.lit(central_meridian)) * cos_phi
    m = F.lit(a) * (F.lit(m1) * phi - F.lit(m2) * F.sin(phi * 2)
                    + F.lit(m3) * F.sin(phi * 4) - F.lit(m4) * F.sin(phi * 6))
    a2, a3 = aa * aa, aa * aa * aa
    a4, a5, a6 = a2 * a2, a2 * a3, a3 * a3
    x = F.lit(k0) * n * (aa + (F.lit(1.0) - t + c) * a3 / 6
                         + (F.lit(5.0) - t * 18 + t * t + c * 72 - F.lit(58 * ep2)) * a5 / 120) \
        + F.lit(false_easting)
    y = F.lit(k0) * (m + n * tan_phi * (a2 / 2
                                        + (F.lit(5.0) - t + c * 9 + c * c * 4) * a4 / 24
                                        + (F.lit(61.0) - t * 58 + t * t + c * 600
                                           - F.lit(330 * ep2)) * a6 / 720))
    return F.struct(x.alias("x"), y.alias("y"))


POINT_JSON = "type string, coordinates array<double>"


def point_from_geojson(geom: Column) -> Column:
    """G1: GeoJSON Point text -> struct(x=lon, y=lat); null for other or bad text."""
    g = F.from_json(geom, POINT_JSON)
    ok = (g["type"] == F.lit("Point")) & (F.size(g["coordinates"]) >= 2)
    return F.when(ok, F.struct(F.get(g["coordinates"], F.lit(0)).alias("x"),
                               F.get(g["coordinates"], F.lit(1)).alias("y")))


def ring_to_utm(ring: Column, **kw) -> Column:
    """Project every vertex of a lon/lat ring (fields x=lon, y=lat)."""
    return F.transform(ring, lambda p: lonlat_to_utm(p["x"], p["y"], **kw))


def close_ring(ring: Column) -> Column:
    """The ring with its first point at its end; null for an empty ring."""
    first = F.get(ring, F.lit(0))
    return F.when(first == F.get(ring, F.size(ring) - 1), ring).when(F.size(ring) > 0, F.concat(ring, F.array(first)))


def ring_moments(pts: Column, x0: Column, y0: Column) -> Column:
    """struct(a, x, y) of a closed ring: its unsigned double area, and that times three times its centroid
    relative to (x0, y0).  Shoelace sums on shifted coordinates (keeps precision for large ones)."""
    n = F.size(pts)

    def term(p, q):
        px, py = p["x"] - x0, p["y"] - y0
        qx, qy = q["x"] - x0, q["y"] - y0
        cross = px * qy - qx * py
        return F.struct(cross.alias("a"), ((px + qx) * cross).alias("x"), ((py + qy) * cross).alias("y"))

    def add(acc, t):
        return F.struct((acc["a"] + t["a"]).alias("a"), (acc["x"] + t["x"]).alias("x"), (acc["y"] + t["y"]).alias("y"))

    def unsigned(acc):  # orientation does not matter
        turn = F.when(acc["a"] < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
        return F.struct((acc["a"] * turn).alias("a"), (acc["x"] * turn).alias("x"), (acc["y"] * turn).alias("y"))

    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    terms = F.zip_with(F.slice(pts, 1, F.greatest(n - 1, F.lit(0))), F.slice(pts, 2, F.greatest(n - 1, F.lit(0))), term)
    return F.aggregate(terms, zero, add, unsigned)


def polygons_centroid(polygons: Column) -> Column:
    """Area-weighted centroid of polygons with holes -> struct(x, y, area).

    ``polygons`` holds for each polygon its closed outer ring and then its closed
    holes, which are subtracted.  Null geometry and zero area give nulls.
    """
    first = F.get(F.get(F.get(polygons, F.lit(0)), F.lit(0)), F.lit(0))
    x0, y0 = first["x"], first["y"]
    parts = F.flatten(F.transform(polygons, lambda polygon: F.transform(polygon, lambda ring, i: F.struct(
        F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("sign"), ring_moments(ring, x0, y0).alias("m")))))

    def total(field: str) -> Column:
        return F.aggregate(parts, F.lit(0.0), lambda acc, p: acc + p["sign"] * p["m"][field])

    a2 = total("a")
    ok = a2 > 0
    return F.struct(F.when(ok, x0 + F.try_divide(total("x"), a2 * 3)).alias("x"),
                    F.when(ok, y0 + F.try_divide(total("y"), a2 * 3)).alias("y"), (a2 / 2).alias("area"))


def ring_centroid(ring: Column) -> Column:
    """Centroid of a simple ring, closed or not -> struct(x, y, area)."""
    return polygons_centroid(F.array(F.array(close_ring(ring))))
