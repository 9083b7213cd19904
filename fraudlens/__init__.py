"""fraudlens: Spark-native fraud-rate and cost reporting."""
