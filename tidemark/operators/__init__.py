"""Operators: DataFrame in, DataFrame out. Nothing here runs a job."""
