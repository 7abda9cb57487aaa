"""Score coded records on tables and streams with plain Spark DataFrames."""
