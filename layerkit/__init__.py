"""Build and check a layered analytical warehouse with Spark DataFrames."""
