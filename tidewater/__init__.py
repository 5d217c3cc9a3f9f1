"""Change-data-capture on Spark: decode typed change records, keep the
latest change per key, enrich from lookup files and upsert into a table."""

__version__ = "0.1.0"
