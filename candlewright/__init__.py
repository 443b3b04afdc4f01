"""Spark-native candle and market-structure analytics."""
