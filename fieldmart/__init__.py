"""fieldmart: Spark-native operators for medallion-style field data."""
