"""Price analytics and text-data preparation on Spark DataFrames."""
