"""Operators for preparing training text, and their keyed queries."""
