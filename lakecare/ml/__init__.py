"""Readmission model on Spark ML."""
