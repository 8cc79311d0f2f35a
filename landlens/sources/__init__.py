"""Readers, sinks and the named-result catalog."""

from landlens.sources.catalog import ViewRegistry
from landlens.sources.ordered import read_manifest, read_ordered, write_ordered
from landlens.sources.publish import AuditFailed, publish, publish_view, published, vacuum
from landlens.sources.readers import (
    boundaries_from_geojson, read_delimited, read_parquet, read_result,
)
from landlens.sources.sinks import declare_table, export_csv, heat_map_feed, stage, write_table

__all__ = ["ViewRegistry", "boundaries_from_geojson", "read_delimited", "read_parquet",
           "read_result", "declare_table", "export_csv", "heat_map_feed", "stage", "write_table",
           "read_manifest", "read_ordered", "write_ordered",
           "AuditFailed", "publish", "publish_view", "published", "vacuum"]
