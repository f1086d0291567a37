"""platewise: Spark-native menu tagging and category preference jobs."""

__version__ = "0.1.0"
