"""Transit-feed analytics on Spark: feeds -> station features -> anomaly scores -> metrics."""

__version__ = "0.1.0"
