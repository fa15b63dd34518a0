"""Whole jobs, and the queries the driver runs."""
