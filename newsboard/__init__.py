"""Newsboard: article analytics as plain PySpark DataFrame functions."""
