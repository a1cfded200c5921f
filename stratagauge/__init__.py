"""Indicator analytics on layered tables, written as Spark DataFrame transformations."""
