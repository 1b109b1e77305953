"""Climatology of large collections of daily series, as Spark DataFrame operators."""
