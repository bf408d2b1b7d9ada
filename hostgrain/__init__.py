"""Security-log features and deliveries as Spark DataFrames."""
