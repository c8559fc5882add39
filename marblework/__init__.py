"""Layered RAW, CLEAN and MART processing as Spark DataFrame work."""
