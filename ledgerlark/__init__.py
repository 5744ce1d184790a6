"""Retail and rental analytics written as lazy PySpark DataFrame plans."""
