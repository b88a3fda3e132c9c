"""Fabula: story-shape analytics as Spark DataFrame and SQL building blocks."""
