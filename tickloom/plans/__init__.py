"""Staging views, marts, read queries and quality checks."""
