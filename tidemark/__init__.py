"""Feature log, point-in-time joins, drift monitoring and model registry on Spark DataFrames."""
