"""Swim-results lakehouse and analytics on PySpark."""
