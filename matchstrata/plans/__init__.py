"""Whole plans: layer jobs and read-side queries."""
