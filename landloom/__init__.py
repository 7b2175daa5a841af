"""landloom: Spark-native cleaning, matching and analysis of published land registers."""

__version__ = "0.1.0"
