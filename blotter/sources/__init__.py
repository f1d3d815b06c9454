"""Readers and writers for incident feeds, demographics and region tables."""

from blotter.sources.readers import (corrupt_records, read_feed, read_arrests, read_complaints, read_table,
                                     read_demographics_wide, read_regions)
from blotter.sources.writers import write_incidents, write_table

__all__ = ["corrupt_records", "read_feed", "read_arrests", "read_complaints", "read_table",
           "read_demographics_wide", "read_regions", "write_incidents", "write_table"]
