"""Assembly analytics as declarative Spark plans."""
