"""Tidemark: a Spark-native medallion warehouse for daily file drops."""
