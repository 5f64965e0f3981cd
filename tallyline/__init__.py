"""Retail order, clickstream and merchandising analytics as PySpark DataFrame jobs."""
