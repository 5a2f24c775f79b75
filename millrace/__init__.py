"""millrace: data contracts, data quality and data preparation on Spark DataFrames."""
