"""Trip analytics on Spark: conform, identify, locate, expand and profile trip records."""
