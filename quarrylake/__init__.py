"""Layered (bronze, silver, gold) analytics as plain PySpark DataFrame functions."""
