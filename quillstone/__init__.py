"""Document governance, hybrid retrieval and training-data preparation on PySpark DataFrames."""
