"""Clearing-data analytics expressed as Spark DataFrame operators."""
