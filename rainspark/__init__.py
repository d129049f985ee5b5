"""Rain-gauge data processing on Spark."""
