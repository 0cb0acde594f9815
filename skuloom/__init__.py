"""Retail and e-commerce reporting on Spark DataFrames."""

__version__ = "0.1.0"
