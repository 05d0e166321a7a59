"""Incremental materialisation as a stream."""
