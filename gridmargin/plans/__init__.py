"""Staging views, marts and report queries."""
