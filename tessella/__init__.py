"""Matrix and feature operators on Spark DataFrames."""
