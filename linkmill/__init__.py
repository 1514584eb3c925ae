"""linkmill: record linkage and analytics as declarative Spark plans."""
