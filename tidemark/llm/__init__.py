"""Operators for preparing training text: tokenising, filtering, deduplicating, mixing, searching."""
