"""Question-driven analytics and corpus jobs on Spark DataFrames."""
