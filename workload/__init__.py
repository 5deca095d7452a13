"""Queries of the driver contract over the given tables."""
