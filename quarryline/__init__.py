"""quarryline: a Spark-native analytics engine for software-engineering agent data."""

__version__ = "0.1.0"
