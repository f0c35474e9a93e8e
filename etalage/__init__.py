"""Etalage: shop analytics as Spark jobs."""
