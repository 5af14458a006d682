"""climaflow: sensor and weather analytics as Spark DataFrame, streaming and MLlib jobs."""

__version__ = "0.1.0"
