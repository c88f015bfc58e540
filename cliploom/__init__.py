"""Clip-dataset curation and analytics as PySpark jobs."""
