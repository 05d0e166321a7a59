"""Operators that prepare training text; nothing outside this folder imports it."""
