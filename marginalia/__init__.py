"""Marginalia: text-evidence analytics on Spark.

Lines, spans, competing readings, corrections and review decisions are plain
tables; every operator is a function from DataFrames to a DataFrame.
"""

__version__ = "0.1.0"
