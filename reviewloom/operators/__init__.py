"""Dataset-level operators."""
