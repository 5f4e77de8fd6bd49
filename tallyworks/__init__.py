"""Sales data-quality and analytics jobs built on Spark DataFrames.

Every operator is a function from DataFrames to DataFrames; the caller owns the session.
"""
