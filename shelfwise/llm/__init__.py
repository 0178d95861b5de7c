"""Operators for preparing training text: search, dedup, scoring, filtering, extraction, encoding."""
