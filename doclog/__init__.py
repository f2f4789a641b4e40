"""Ordered change logs on Spark: capture mutation requests, cut them into segments, replay them into tables."""
