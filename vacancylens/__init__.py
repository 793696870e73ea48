"""Job-posting snapshot analytics on Spark DataFrames."""

__version__ = "0.1.0"
