"""Analytics over daily job postings and their pages, built on Spark DataFrames."""
