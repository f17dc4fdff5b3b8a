"""E-commerce order analytics on Spark: CSV to raw snapshots, silver tables, marts and data tests."""

from orderloom.session import configure, get_session, scratch_dir, shuffle_partitions

__all__ = ["configure", "get_session", "scratch_dir", "shuffle_partitions"]
