"""News-article processing on Spark: every operator maps DataFrames to DataFrames."""
