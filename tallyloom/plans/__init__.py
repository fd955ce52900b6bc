"""Whole runs, and the named queries."""
