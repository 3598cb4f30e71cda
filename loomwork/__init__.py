"""Loomwork: data wrangling operators written as plain Spark DataFrame code.

The package turns raw tables and streams into published data products.  Every
operator takes DataFrames and returns DataFrames; planning and execution stay
with Spark.  See README.md for a map of the modules.
"""

__version__ = "0.1.0"
