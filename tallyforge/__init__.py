"""tallyforge: evaluation-run analytics and training-data operators as Spark DataFrames."""
