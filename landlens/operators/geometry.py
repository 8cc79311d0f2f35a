"""Geometry operators (G1-G3) at DataFrame level.

The Column functions in :mod:`landlens.functions.geo` reference their ring
argument several times (and inside lambdas), so an expensive ring
*expression* (e.g. a projected ring) must be materialised as a column first,
or Catalyst would evaluate it once per reference per vertex.  These operators
do the staging: each step is a separate projection that Catalyst keeps
separate because its output is used more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landlens.functions.geo import (
    close_ring, lonlat_to_utm, point_from_geojson, polygons_centroid, ring_to_utm,
)


def with_centroid(df: DataFrame, polygons_col: str = "polygons", project: bool = True,
                  x_col: str = "centroid_x", y_col: str = "centroid_y") -> DataFrame:
    """G3 (optional) then G2: centroid of each row's polygons, in UTM 10N metres when
    ``project`` (reprojection *before* the centroid), else in ring units; holes are
    subtracted, null polygons give nulls."""
    def ring(r):
        return close_ring(ring_to_utm(r) if project else r)

    work = df.withColumn("__polygons", F.transform(polygons_col, lambda polygon: F.transform(polygon, ring)))
    work = work.withColumn("__c", polygons_centroid(F.col("__polygons")))
    return work.withColumn(x_col, F.col("__c.x")).withColumn(y_col, F.col("__c.y")).drop("__polygons", "__c")


def with_projected_point(df: DataFrame, geojson_col: str | None = None, lon_col: str | None = None,
                         lat_col: str | None = None, x_col: str = "x", y_col: str = "y") -> DataFrame:
    """G1 + G3: a point from GeoJSON text (or lon/lat columns) to UTM 10N metres."""
    if geojson_col is not None:
        work = df.withColumn("__pt", point_from_geojson(F.col(geojson_col)))
        lon, lat = F.col("__pt.x"), F.col("__pt.y")
    else:
        work = df
        lon, lat = F.col(lon_col), F.col(lat_col)
    work = work.withColumn("__utm", lonlat_to_utm(lon, lat))
    out = work.withColumn(x_col, F.col("__utm.x")).withColumn(y_col, F.col("__utm.y"))
    return out.drop("__utm", "__pt") if geojson_col is not None else out.drop("__utm")
