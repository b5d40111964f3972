"""Everyday data work on Spark tables and streams."""
