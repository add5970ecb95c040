"""washline: land, clean, route and publish tabular data with plain Spark DataFrames.

Every operator takes a DataFrame and returns a DataFrame built from built-in Spark
expressions.  Nothing here creates a session or changes its settings.
"""
