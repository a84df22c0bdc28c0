"""Structured Streaming: landing files -> Bronze -> Silver merges -> dimensions, each micro-batch exactly once."""

from stratum.streaming.ingest import (DimensionSink, MergeSink, TableMergeSink, has_new_files, land_batch, pending_files, pending_rows,
                                      read_bronze, stream_changes, stream_ingest, stream_merge)

__all__ = ["stream_ingest", "read_bronze", "stream_merge", "stream_changes", "has_new_files", "pending_files", "pending_rows",
           "land_batch", "MergeSink", "TableMergeSink", "DimensionSink"]
