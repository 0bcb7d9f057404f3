"""Tielens: relationship-data analytics expressed as PySpark DataFrame transformations."""
