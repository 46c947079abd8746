"""Operators for preparing training text, each with its own general interface, and their queries."""
