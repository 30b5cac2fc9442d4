"""lexloom: statute citation graphs, retrieval and corpus work on Spark DataFrames."""

__version__ = "0.1.0"
