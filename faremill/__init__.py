"""faremill: trip-record analytics expressed as lazy Spark DataFrames."""

__version__ = "0.1.0"
