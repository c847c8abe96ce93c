"""Batch product recommendations as Spark DataFrame jobs."""
