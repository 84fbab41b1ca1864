"""Operators for preparing training text at scale (counts, cleaning, mixing, scoring)."""
