"""Retail-banking lakehouse jobs written as Spark DataFrame transforms."""
