"""Change-stream analytics expressed as Spark plans."""
