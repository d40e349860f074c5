"""Contract-driven bronze -> silver -> gold processing on Spark DataFrames."""
