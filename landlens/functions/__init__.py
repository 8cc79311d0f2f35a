"""Column expressions: all built from ``pyspark.sql.functions`` (JVM side, codegen)."""

from landlens.functions.classify import class_of, indicator, indicator_sum
from landlens.functions.casts import conform_column, to_int
from landlens.functions.numeric import (
    finish_avg, percent_change, safe_corr, share_percent, two_digit_year,
)
from landlens.functions.text import (
    comma_count, extract_pattern, normalise_names, point_part, truncate,
)
from landlens.functions.geo import lonlat_to_utm, point_from_geojson, ring_centroid, ring_to_utm

__all__ = [
    "class_of", "indicator", "indicator_sum", "conform_column", "to_int",
    "finish_avg", "percent_change", "safe_corr", "share_percent", "two_digit_year",
    "comma_count", "extract_pattern", "normalise_names", "point_part", "truncate",
    "ring_centroid", "lonlat_to_utm", "point_from_geojson", "ring_to_utm",
]
