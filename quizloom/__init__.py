"""Question-answer benchmark datasets from exam papers, built on Spark DataFrames."""
