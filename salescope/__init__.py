"""Retail sales analytics written as Spark DataFrame programs."""
