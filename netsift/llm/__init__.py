"""Operators for preparing training text, built on Spark; nothing else in the library imports them."""
