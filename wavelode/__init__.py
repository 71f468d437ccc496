"""Track analytics on Spark: layered tables, profiling, features, models."""
