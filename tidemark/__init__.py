"""Layered tabular pipelines and binary-outcome scoring on Spark DataFrames."""
