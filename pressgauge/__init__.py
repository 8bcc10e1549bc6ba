"""pressgauge: news, visit and search-log analytics as Spark DataFrame operators."""

__version__ = "0.1.0"
