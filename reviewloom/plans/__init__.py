"""Whole jobs and their command line."""
