"""Market-basket analytics and next-basket prediction on Spark DataFrames."""
