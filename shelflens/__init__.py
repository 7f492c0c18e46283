"""Retail operations analytics as DataFrame -> DataFrame functions on Spark."""
