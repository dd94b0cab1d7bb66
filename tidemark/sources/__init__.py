"""Readers of shared sources, and the tables this library writes."""

from tidemark.sources.control import ControlTables
from tidemark.sources.readers import file_listing, listing_mark, read_source
from tidemark.sources.sinks import write_sink
from tidemark.sources.snapshots import Snapshot, SnapshotStore
from tidemark.sources.workdir import work_dir

__all__ = ["ControlTables", "Snapshot", "SnapshotStore", "file_listing", "listing_mark",
           "read_source", "work_dir", "write_sink"]
