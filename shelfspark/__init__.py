"""Catalogue price intelligence as Spark DataFrame operations."""
