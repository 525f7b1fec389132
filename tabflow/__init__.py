"""Table and stream jobs on Spark: typed ingestion, routed writes, keyed and
windowed counts, table layouts with their lookups, and synthetic rows."""

__version__ = "0.1.0"
