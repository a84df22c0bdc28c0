"""Sources and sinks: CSV landing files, load by name with quarantine, versioned snapshot tables."""

from stratum.sources.csv import (read_csv, infer_schema, normalize_name, normalize_names, load_by_name,
                                 load_csv_with_quarantine, CSV_OPTIONS)
from stratum.sources.snapshots import SnapshotTable
from stratum.sources.inventory import stage_inventory, remove_files

__all__ = ["read_csv", "infer_schema", "normalize_name", "normalize_names", "load_by_name",
           "load_csv_with_quarantine", "CSV_OPTIONS", "SnapshotTable", "stage_inventory", "remove_files"]
