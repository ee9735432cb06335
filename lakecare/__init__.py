"""Layered clinical and claims analytics on plain Spark."""
