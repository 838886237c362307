"""Log analytics on Spark: every operation is a function from DataFrame to DataFrame."""

__version__ = "0.1.0"
