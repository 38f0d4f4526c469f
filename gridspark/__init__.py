"""Gridded climate data work as Spark DataFrame jobs."""
