"""Gridwright: Q&A curation and usage analytics as DataFrame operators on Spark.

Every operator is a function from DataFrames to a DataFrame.  Nothing here imports the
``llm`` subpackage; it can be removed without touching the rest.
"""

__version__ = "0.1.0"
