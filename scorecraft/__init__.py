"""scorecraft: Spark-native credit-scorecard analytics (see README.md)."""
__version__ = "0.1.0"
