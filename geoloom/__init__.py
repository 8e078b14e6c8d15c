"""geoloom: location-data preparation on Spark DataFrames."""
