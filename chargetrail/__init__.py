"""Spark operators and jobs for electric-vehicle charging message logs."""
