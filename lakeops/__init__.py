"""Lakehouse data operations written for Spark DataFrames."""
