"""Operators for preparing training text at scale, and the queries that run them."""
