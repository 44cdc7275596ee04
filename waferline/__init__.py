"""Wafer-level feature tables from fab process history, built on PySpark DataFrames."""
