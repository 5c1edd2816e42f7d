"""Dated sales history and sales analytics, written as Spark DataFrame jobs."""
