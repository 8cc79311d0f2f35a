"""DataFrame-in / DataFrame-out operators."""

from landlens.operators import aggregate, clean, correlate, fanout, followup, geometry, joins

__all__ = ["aggregate", "clean", "correlate", "fanout", "followup", "geometry", "joins"]
