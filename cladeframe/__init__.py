"""Strain-variant analytics and corpus processing on Spark DataFrames."""
