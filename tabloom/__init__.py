"""Analyst operators for Spark: plain functions from DataFrame to DataFrame."""
