"""Page-structured text, its review data and corpus preparation, on Spark DataFrames."""
