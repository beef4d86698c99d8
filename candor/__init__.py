"""candor: a Spark-native engine for checking, selecting and comparing candidate texts."""

__version__ = "0.1.0"
